"""Removal of word windows that started before, on a compacted de Bruijn graph.

A window of ``window`` words is an edge of the graph; the words it shares with the next window
are the node between them. Only edges that can repeat are built: windows are gathered by
keys of their content (``chunks``); keys that occur once are done, and a chunk whose key never
has another content repeats or not as a whole. Where chunks under one key differ, the first
copy of each kind gives its windows as edges. Of those that occur in several kinds, paths
without branches -- every place of an edge is followed by the same edge, and every place of
that one preceded by it, checked on source coordinates -- are compacted by pointer doubling
through joins. A compacted path is kept at its first place and removed at the others.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from assayframe.session import settle

from .chunks import keyed, mixed_kinds, repeated_chunks, unkeyed
from .text import SLICE_BYTES, Words, gram_hashes, map_arrow, slices, word_units

#: Words of an anchor; windows of fewer words use half of them.
GRAM = 6
_PLACE = ["doc", "print", "pos"]


def _edges(asked: DataFrame, docs: DataFrame, window: int) -> DataFrame:
    """(one, two, doc, print, pos): the windows of the asked chunks, by two hashes."""
    wanted = asked.groupBy("doc", "print").agg(
        F.collect_list(F.struct("start", "count")).alias("chunks"))
    joined = wanted.join(docs.dropDuplicates(["doc", "print"]), ["doc", "print"])

    def run(batch: pa.RecordBatch):
        doc, print_ = (batch.column(i).to_numpy() for i in (0, 1))
        lists = batch.column(2)
        at_list = lists.offsets.to_numpy()
        begin, count = (lists.values.field(i).to_numpy() for i in (0, 1))
        for row, data, at in slices(batch.column(3)):
            if len(data) > 2 * SLICE_BYTES:
                units = word_units(data)
                begins = np.array([0, len(units)])
            else:
                words = Words(data, at)
                units, begins = words.hashes(), words.first
            one, two = (gram_hashes(units, window, salt) for salt in (1, 2))
            for i in range(len(at) - 1):
                part = slice(at_list[row + i], at_list[row + i + 1])
                pos = np.repeat(begin[part] - np.cumsum(count[part]) + count[part],
                                count[part]) + np.arange(count[part].sum())
                place = begins[i] + pos
                yield [one[place].view(np.int64), two[place].view(np.int64),
                       np.full(len(pos), doc[row + i]), np.full(len(pos), print_[row + i]), pos]

    return map_arrow(joined.select("doc", "print", "chunks", "text"), run,
                     "one long, two long, doc long, print long, pos long")


def _links(places: DataFrame) -> DataFrame:
    """(e, f): edges where every place of ``e`` is followed by ``f`` and every place of ``f``
    preceded by ``e``. A text's places are bounded by its length."""
    order = Window.partitionBy("doc", "print").orderBy("pos")

    def beside(step: int):
        other = F.lead("e", step).over(order) if step > 0 else F.lag("e", -step).over(order)
        pos = F.lead("pos", step).over(order) if step > 0 else F.lag("pos", -step).over(order)
        return F.when(pos == F.col("pos") + step, other)

    seen = places.select("e", beside(1).alias("next"), beside(-1).alias("last")) \
        .groupBy("e").agg(F.count("*").alias("n"), F.count("next").alias("nn"),
                          F.min("next").alias("f"), F.max("next").alias("f2"),
                          F.count("last").alias("ln"), F.min("last").alias("d"),
                          F.max("last").alias("d2"))
    seen = settle(seen, "edges")
    ahead = seen.where("n = nn AND f = f2").select("e", "f")
    back = seen.where("n = ln AND d = d2").select(F.col("e").alias("to"), F.col("d").alias("by"))
    return ahead.join(back, F.expr("f = to AND e = by")).select("e", "f")


def _heads(links: DataFrame) -> DataFrame:
    """(e, head, steps) for the edges that something links to: the path's first edge.

    Pointers double each round; a path ends at a text's end at the latest, so the rounds are
    bounded by the logarithm of the longest text's words.
    """
    now = settle(links.select(F.col("f").alias("e"), F.col("e").alias("head"),
                              F.lit(1).cast("long").alias("steps")), "heads")
    while True:
        far = now.select(F.col("e").alias("via"), F.col("head").alias("top"),
                         F.col("steps").alias("more"))
        moved = settle(now.join(far, F.expr("head = via"), "left").select(
            "e", F.coalesce("top", "head").alias("head"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            F.col("top").isNotNull().alias("moved")), "heads")
        if moved.where("moved").isEmpty():
            return moved.drop("moved")
        now = moved.drop("moved")


def _path_spans(asked: DataFrame, docs: DataFrame, window: int) -> DataFrame:
    """(doc, print, start, size): windows of the asked chunks that start earlier in another."""
    edges = settle(_edges(asked, docs, window), "windows")
    often = settle(edges.groupBy("one", "two").agg(
        F.count("*").alias("n"), F.min(F.struct(*_PLACE)).alias("first"))
        .where("n > 1").select("one", "two", F.struct("one", "two").alias("e"), "first"), "often")
    places = settle(edges.join(often, ["one", "two"]).select("e", *_PLACE, "first"), "places")
    heads = settle(_heads(_links(places)), "paths")
    length = heads.groupBy("head").agg((F.max("steps") + 1).alias("length"))
    inner = heads.select(F.col("e").alias("inner"))
    return places.join(inner, F.expr("e = inner"), "left_anti") \
        .join(length, F.expr("e = head"), "left") \
        .where(F.struct(*_PLACE) != F.col("first")) \
        .select("doc", "print", F.col("pos").alias("start"),
                (F.coalesce("length", F.lit(1)) + window - 1).alias("size"))


def earlier_spans(docs: DataFrame, window: int = 20) -> DataFrame:
    """(doc, print, start, size): words covered by windows that start earlier; spans overlap."""
    met, kinds = repeated_chunks(docs, window, min(GRAM, max(1, window // 2)), words=True)
    copies = met.join(kinds.where("n > 1").select("anchor", "content", "at"),
                      ["anchor", "content"]) \
        .where(F.struct("doc", "print", "start") != F.struct("at.doc", "at.print", "at.start")) \
        .select("doc", "print", "start", (F.col("count") + window - 1).alias("size"))
    asked = settle(mixed_kinds(kinds).select("doc", "print", "start", "count"), "asked")
    return copies.union(_path_spans(asked, docs, window))


def remove_earlier(docs: DataFrame, window: int = 20, text: str = "text", key: str = "doc_id",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: key, ``keep`` columns, n_words, n_removed, kept_sha256, kept.

    Removes each word covered by a window of ``window`` words that also starts earlier: at a
    smaller key, or earlier in the same text. ``kept`` are the other words, joined by one
    space (UTF-8). A null text has no words. A null key comes before all others; rows with
    equal keys are ordered by a hash of their texts, and those with equal texts too are one
    document: they keep and lose the same words.
    """
    plain = keyed(docs, key, text, keep)
    spans = settle(earlier_spans(plain.select("doc", "print", "text"), window), "spans")
    listed = spans.groupBy("doc", "print").agg(
        F.collect_set(F.struct("start", "size")).alias("spans")) \
        .withColumnsRenamed({"doc": "d", "print": "p"})
    joined = plain.join(listed, F.expr("doc = d AND print = p"), "left")
    passed = joined.select("own_key", *[f"keep_{c}" for c in keep])
    kinds = passed.schema.simpleString()[7:-1]

    def cut(batch: pa.RecordBatch):
        spans = batch.column(1)
        lists = spans.offsets.to_numpy()
        start, size = (spans.values.field(i).to_numpy() for i in (0, 1))
        null = spans.is_null().to_numpy(zero_copy_only=False)
        total, removed, digest, kept = [], [], [], []
        for i, x in enumerate(batch.column(0)):
            words = (x.as_py() or "").encode().split()
            total.append(len(words))
            if not null[i]:
                step = np.zeros(len(words) + 1, np.int64)
                here = slice(lists[i], lists[i + 1])
                np.add.at(step, start[here], 1)
                np.add.at(step, start[here] + size[here], -1)
                gone = np.cumsum(step)[:-1] > 0
                words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            removed.append(total[-1] - len(words))
            kept.append(b" ".join(words))
            digest.append(hashlib.sha256(kept[-1]).hexdigest())
        return pa.RecordBatch.from_arrays(
            [*batch.columns[2:], pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(digest, pa.string()), pa.array(kept, pa.binary())],
            names=[*batch.schema.names[2:], "n_words", "n_removed", "kept_sha256", "kept"])

    out = joined.select("text", "spans", *passed.columns).mapInArrow(
        lambda batches: map(cut, batches),
        kinds.replace(",", ", ").replace(":", " ")
        + ", n_words long, n_removed long, kept_sha256 string, kept binary")
    return out.select(*unkeyed(key, keep), "n_words", "n_removed", "kept_sha256", "kept")
