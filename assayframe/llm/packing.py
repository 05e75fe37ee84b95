"""Best-fit packing of texts into bins with conflicts.

Bins of one size take pieces of texts, the longest first. A bin carries two bitmaps, of the
sources and of the duplicate clusters it holds; a piece fits a bin that has room and neither
its source's nor its cluster's bit. Bins are kept in the order of their residual room: the
search starts at the smallest residual that is enough and goes on to each successor until it
finds the tightest compatible bin, else a new one is opened. Texts longer than a bin fill
whole bins first; their rest is packed like any other piece.

Pieces are dealt to shards by a hash of all their fields and the number of the repeat, so
neither a hot source nor a repeated row fills one; the number of shards follows the number of
pieces. Within a shard the order is fixed, so a lost task packs the same bins again.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from assayframe.session import settle

from . import simhash

#: Words of a bin, and pieces of a shard on average.
CAPACITY, SHARD = 2048, 1500


def best_fit(pieces: list[tuple[int, object, object]], capacity: int) -> list[int]:
    """The bin of each (size, source, cluster); sizes fall and are at most ``capacity``.

    A source or cluster of None conflicts with nothing.
    """
    if any(not 0 <= p[0] <= capacity for p in pieces):
        raise ValueError("sizes lie between zero and the capacity")
    bits: tuple[dict, dict] = ({}, {})
    order: list[tuple[int, int]] = []  # (residual, bin)
    maps: list[list[int]] = []
    out = []
    for size, source, cluster in pieces:
        mine = [0 if v is None else 1 << seen.setdefault(v, len(seen))
                for v, seen in zip((source, cluster), bits, strict=True)]
        at = bisect_left(order, (size, -1))
        while at < len(order):
            held = maps[order[at][1]]
            if not (held[0] & mine[0] or held[1] & mine[1]):
                break
            at += 1
        if at < len(order):
            room, number = order.pop(at)
        else:
            room, number = capacity, len(maps)
            maps.append([0, 0])
        maps[number][0] |= mine[0]
        maps[number][1] |= mine[1]
        insort(order, (room - size, number))
        out.append(number)
    return out


def _word_count(text: str):
    return F.size(_words(text)).cast("long")


def _words(text: str):
    return F.expr(f"filter(split(coalesce(`{text}`, ''), '[ \\\\t\\\\n\\\\x0B\\\\f\\\\r]+'), "
                  "x -> x != '')")


def pack_apart(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source",
               **options) -> DataFrame:
    """``pack`` with near duplicates (SimHash groups) as clusters, so that no bin holds two copies
    of a text, however it was changed a little. Texts are read in two narrow passes; only keys,
    sizes and groups are shuffled."""
    near = simhash.near_duplicates(docs, text, key).select(
        F.col(key).alias("near_key"), F.col("print").alias("near_print"), "root").distinct()
    sized = docs.select(
        docs[key].cast("long").alias(key), docs[source].cast("string").alias(source),
        F.xxhash64(F.coalesce(docs[text], F.lit(""))).alias("print"),
        _word_count(text).alias("total"))
    joined = sized.join(near, F.col(key).eqNullSafe(F.col("near_key"))
                        & (F.col("print") == F.col("near_print")), "left")
    return pack(joined, text=text, key=key, source=source, size=F.col("total"),
                cluster=F.when(F.col("total") > 0, F.col("root")), **options)


def pack(docs: DataFrame, capacity: int = CAPACITY, shard: int = SHARD, text: str = "text",
         key: str = "doc_id", source: str = "source", size=None, cluster=None) -> DataFrame:
    """One row per piece: key, piece, copy, start, size, shard, bin, bin_id. "Tightest" is that of
    a shard's bins.

    ``size``: a column of whole numbers (default: the text's words, split at white space);
    ``cluster``: a column that is equal for duplicates (default: a hash of the words, in lower
    case). ``start`` counts in the same unit. Every row of ``docs`` has a piece at least: null
    and empty texts have one of size 0. Texts without words belong to no cluster, a null
    source conflicts with nothing. Rows that are equal in key, source, cluster and size are
    numbered by ``copy``, from 0. ``bin_id`` is unique over all shards.
    """
    if capacity < 1 or shard < 1:
        raise ValueError("capacity and shard are at least 1")
    count = _word_count(text) if size is None else F.greatest(
        F.coalesce(size.cast("long"), F.lit(0)), F.lit(0))
    if cluster is None:
        words = _words(text)
        group = F.when(F.size(words) > 0, F.xxhash64(F.lower(F.array_join(words, " "))))
    else:
        group = F.when(cluster.isNotNull(), F.xxhash64(cluster))
    rows = docs.select(docs[key].cast("long").alias("key"),
                       docs[source].cast("string").alias("source"),
                       group.alias("cluster"), count.alias("total"))
    # Repeats of a row are counted before they are told apart, so a hot row is no hot group.
    rows = rows.groupBy("key", "source", "cluster", "total").agg(F.count("*").alias("n")) \
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))) \
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(
            F.lit(0), F.ceil(F.col("total") / capacity) - 1)))) \
        .withColumn("start", F.col("piece") * capacity) \
        .withColumn("size", F.least(F.col("total") - F.col("start"), F.lit(capacity)))
    pieces = settle(rows.drop("n", "total"), "pieces")
    shards = max(1, -(-pieces.count() // shard))
    names = ["key", "piece", "copy", "start", "size", "shard"]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("key", "ascending"),
                               ("piece", "ascending"), ("copy", "ascending"),
                               ("source", "ascending"), ("cluster", "ascending")])
        bins = best_fit(list(zip(*(table[c].to_pylist() for c in ("size", "source", "cluster")),
                                 strict=True)), capacity)
        return table.select(names).append_column("bin", pa.array(bins, pa.int64()))

    placed = pieces.withColumn("shard", F.pmod(
        F.xxhash64("key", "source", "cluster", "piece", "copy"), F.lit(shards).cast("long"))) \
        .groupBy("shard").applyInArrow(run, ", ".join(f"{n} long" for n in [*names, "bin"]))
    return placed.select(F.col("key").alias(key), "piece", "copy", "start", "size", "shard", "bin",
                         (F.col("bin") * shards + F.col("shard")).alias("bin_id"))
