"""Removal of byte strings that also start anywhere else, over all texts.

Every window of ``length`` bytes is gathered by a key, a hash of its content anchor with the
bytes next to it (``anchors``). Keys that occur once are done. Among the rest, equal chunks are
merged before any grouping; one that occurs twice is repeated as a whole. Where chunks under one
key differ, one copy of each goes to a shard, chosen by the key, and each shard finds its
repeated windows by breadth-first interval expansion on a Burrows-Wheeler transform, which stops
at ``length`` (``bwt``).

A shard holds some ``SHARD_BYTES``. A key with more than ``GROUP`` different chunks (the ends of a
passage that very many texts share) would make one shard grow with the input, so its chunks are
halved, and their halves gathered by more of the bytes next to the anchor, until no key has as
many: at the latest when a part is one window, of which there is only one kind. Each round
leaves what has become unique or wholly equal; a chunk gives two rows a round and goes through
the transform like any other once its key is small.

Only hashes and places are shuffled, texts twice (to cut out chunks and to apply spans) and the
chunks themselves. Long texts are cut into overlapping slices.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from assayframe.session import settle

from . import anchors, bwt
from .chunks import keyed, mixed_kinds, repeated_chunks, unkeyed
from .text import map_arrow, texts_of

#: Bytes of the gram that an anchor is; windows shorter than twice this use half of them.
GRAM = 32
#: Text of a shard, about, and different chunks of one key that a shard takes.
SHARD_BYTES, GROUP = 1 << 20, 1000


#: Rows that carry a chunk: its key and content, the place of one copy, its bytes, and the offset
#: of its anchor and the part of offsets it belongs to.
_PIECE = ("anchor long, content long, doc long, print long, start long, piece binary, "
          "offset int, low int, high int")
_PLACE = ["doc", "print", "start"]


def _cut(asked: DataFrame, docs: DataFrame, length: int, gram: int) -> DataFrame:
    """The asked chunks with their bytes."""
    wanted = asked.groupBy("doc", "print").agg(
        F.collect_list(F.struct("anchor", "content", "start", "size")).alias("pieces"))
    joined = wanted.join(docs.dropDuplicates(["doc", "print"]), ["doc", "print"]).select(
        "doc", "print", "pieces", F.col("text"))
    most = length - gram
    half = int(anchors.halves(np.int64(0), np.int64(most)))

    def run(batch: pa.RecordBatch):
        doc, print_ = (batch.column(i).to_numpy() for i in (0, 1))
        data, at = texts_of(batch.column(3))
        pieces = batch.column(2)
        offsets, flat = pieces.offsets.to_numpy(), pieces.values
        anchor, content, start, size = (flat.field(i).to_numpy() for i in range(4))
        owner = np.repeat(np.arange(len(pieces)), np.diff(offsets))
        begin = at[owner] + start
        for i in range(0, len(begin), 5000):
            part = slice(i, i + 5000)
            cut = [data[b:b + s] for b, s in zip(begin[part], size[part], strict=True)]
            offset = np.array([anchors.anchor_of(p, length, gram) for p in cut], np.int32)
            upper = offset >= half
            yield [anchor[part], content[part], doc[owner[part]], print_[owner[part]],
                   start[part], [p.tobytes() for p in cut], offset,
                   np.where(upper, half, 0).astype(np.int32),
                   np.where(upper, most, max(0, half - 1)).astype(np.int32)]

    return map_arrow(joined, run, _PIECE)


def _by_transform(pieces: DataFrame, shard_bytes: int, length: int) -> DataFrame:
    """(doc, print, start, size): repeated windows of pieces, found shard by shard."""

    def run(table: pa.Table) -> pa.Table:
        found = bwt.repeats(table["piece"].to_pylist(), length)
        start = table["start"].to_numpy()
        rows, first, size = [], [], []
        for i, flags in enumerate(found):
            edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
            rows += [i] * (len(edge) // 2)
            first.append(edge[::2] + start[i])
            size.append(edge[1::2] - edge[::2] + length - 1)
        none, rows = [np.zeros(0, np.int64)], pa.array(rows, pa.int64())
        return pa.table({"doc": table["doc"].take(rows), "print": table["print"].take(rows),
                         "start": np.concatenate(first + none),
                         "size": np.concatenate(size + none)})

    volume = pieces.agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    shards = max(1, -(-volume // shard_bytes))
    return pieces.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))) \
        .groupBy("shard").applyInArrow(run, "doc long, print long, start long, size long")


def _halved(pieces: DataFrame, length: int, gram: int) -> DataFrame:
    """Both halves of each piece's part, under their own keys."""

    def run(batch: pa.RecordBatch):
        doc, print_, start = (batch.column(i).to_numpy() for i in (2, 3, 4))
        offset, low, high = (batch.column(i).to_numpy().astype(np.int64) for i in (6, 7, 8))
        data, at = texts_of(batch.column(5))
        count = np.diff(at) - length + 1
        middle = anchors.halves(low, high)
        for a, b in ((middle, high), (low, middle - 1)):
            # Window j has the offset ``offset - j``.
            first = np.maximum(offset - b, 0)
            last = np.minimum(offset - a, count - 1)
            has = np.flatnonzero(last >= first)
            if len(has) == 0:
                continue
            begin = at[has] + first[has]
            end = at[has] + last[has] + length
            key = anchors.keys(data, at[has] + offset[has], a[has], b[has], length, gram)
            content = anchors.range_hashes(data, begin, end)
            yield [key.view(np.int64), content.view(np.int64), doc[has], print_[has],
                   start[has] + first[has],
                   [data[i:j].tobytes() for i, j in zip(begin, end, strict=True)],
                   (offset[has] - first[has]).astype(np.int32), a[has].astype(np.int32),
                   b[has].astype(np.int32)]

    names = [c.split(" ")[0] for c in _PIECE.split(", ")]
    return map_arrow(pieces.select(*names), run, _PIECE)


def _parted(hot: DataFrame, length: int, gram: int, group: int) -> list[DataFrame]:
    """[spans that repeat as a whole, pieces under small keys], round by round, of pieces under
    keys with very many kinds."""
    whole, small = [], []
    while not hot.isEmpty():
        rows = settle(_halved(hot, length, gram), "halves")
        kinds = rows.groupBy("anchor", "content").agg(
            F.count("*").alias("n"), F.min(F.struct(*_PLACE)).alias("at"))
        sizes = kinds.groupBy(F.col("anchor").alias("a")).agg(F.count("*").alias("kinds"))
        kinds = settle(kinds.join(sizes, F.col("anchor") == F.col("a")).drop("a"), "half-kinds")
        equal = kinds.where("n > 1").select("anchor", "content")
        whole.append(rows.join(equal, ["anchor", "content"], "left_semi").select(
            *_PLACE, F.octet_length("piece").cast("long").alias("size")))
        # One copy of each kind whose key has several.
        chosen = kinds.where("kinds > 1").select(
            F.col("anchor").alias("a"), F.col("content").alias("c"), "kinds", "at")
        one = rows.join(chosen, (F.col("anchor") == F.col("a")) & (F.col("content") == F.col("c"))
                        & (F.struct(*_PLACE) == F.col("at"))).drop("a", "c", "at")
        one = settle(one, "half-pieces")
        small.append(one.where(F.col("kinds") <= group).drop("kinds"))
        hot = one.where(F.col("kinds") > group).drop("kinds")
    return [whole, small]


def repeated_spans(docs: DataFrame, length: int = 200, shard_bytes: int = SHARD_BYTES,
                   group: int = GROUP) -> DataFrame:
    """(doc, print, start, size): bytes that repeated windows cover; spans may overlap."""
    gram = min(GRAM, max(1, length // 2))
    met, kinds = repeated_chunks(docs, length, gram, words=False)
    whole = met.join(kinds.where("n > 1").select("anchor", "content"), ["anchor", "content"],
                     "left_semi").select(*_PLACE, (F.col("count") + length - 1).alias("size"))
    asked = settle(mixed_kinds(kinds).withColumn("size", F.col("count") + length - 1), "asked")
    pieces = settle(_cut(asked, docs, length, gram).join(
        asked.select(F.col("anchor").alias("a"), F.col("content").alias("c"), "kinds"),
        F.expr("anchor = a AND content = c")).drop("a", "c"), "pieces")
    equal, small = _parted(pieces.where(F.col("kinds") > group).drop("kinds"), length, gram,
                           group)
    pieces = pieces.where(F.col("kinds") <= group).drop("kinds")
    for more in small:
        pieces = pieces.unionByName(more)
    out = whole.unionByName(_by_transform(pieces, shard_bytes, length))
    for more in equal:
        out = out.unionByName(more)
    return out


def removed_runs(start: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the maximal runs that spans cover in a text of ``length`` bytes."""
    order = np.argsort(start, kind="stable")
    begin, end = start[order], np.maximum.accumulate(start[order] + size[order])
    opens = np.flatnonzero(np.concatenate(([True], begin[1:] > end[:-1])))
    return begin[opens], np.minimum(end[np.append(opens[1:], len(end)) - 1], length)


def _apply(docs: DataFrame, spans: DataFrame, as_text: bool) -> DataFrame:
    """Per text: n_bytes, n_removed, n_spans and the bytes that are kept."""
    listed = spans.groupBy("doc", "print").agg(
        F.collect_set(F.struct("start", "size")).alias("spans")) \
        .withColumnsRenamed({"doc": "d", "print": "p"})
    joined = docs.join(listed, F.expr("doc = d AND print = p"), "left")
    passed = [c for c in joined.columns if c not in ("text", "spans", "doc", "print", "d", "p")]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString().replace('bigint', 'long')}"
                      for f in joined.select(*passed).schema.fields)

    def run(batch: pa.RecordBatch):
        data, at = texts_of(batch.column(0))
        spans = batch.column(1)
        lists = spans.offsets.to_numpy()
        start, size = (spans.values.field(i).to_numpy() for i in (0, 1))
        null = spans.is_null().to_numpy(zero_copy_only=False)
        removed, runs, kept = [], [], []
        for i in range(batch.num_rows):
            text = data[at[i]:at[i + 1]]
            if null[i]:
                removed.append(0), runs.append(0), kept.append(text.tobytes())
                continue
            here = slice(lists[i], lists[i + 1])
            begin, end = removed_runs(start[here], size[here], len(text))
            removed.append(int((end - begin).sum()))
            runs.append(len(begin))
            kept.append(b"".join(text[j:k].tobytes() for j, k in zip(
                np.concatenate(([0], end)), np.append(begin, len(text)), strict=True)))
        yield [batch.column(2 + k) for k in range(len(passed))] + [
            np.diff(at), removed, runs, [hashlib.sha256(k).hexdigest() for k in kept],
            [k.decode("utf-8", "ignore") for k in kept] if as_text else kept]

    return map_arrow(joined.select("text", "spans", *passed), run,
                     kinds + ", n_bytes long, n_removed long, n_spans long, "
                             "kept_sha256 string, kept "
                             + ("string" if as_text else "binary"))


def remove_repeats(docs: DataFrame, length: int = 200, text: str = "text", key: str = "doc_id",
                   keep: tuple[str, ...] = (), shard_bytes: int = SHARD_BYTES,
                   group: int = GROUP, as_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: key, ``keep`` columns, n_bytes, n_removed, n_spans,
    kept_sha256, kept.

    Removes each UTF-8 byte covered by a string of ``length`` bytes that also starts anywhere
    else, in the same text or another; matches never cross texts. A null text is empty. Rows
    with equal keys and texts are copies of each other and share their spans. A cut may fall
    inside a character, so ``kept`` is binary; ``as_text`` makes it a string without the bytes
    of broken characters.
    """
    plain = keyed(docs, key, text, keep)
    base = plain.select("doc", "print", "text")
    spans = settle(repeated_spans(base, length, shard_bytes, group), "spans")
    out = _apply(plain, spans, as_text)
    return out.select(*unkeyed(key, keep), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
