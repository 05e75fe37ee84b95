"""Spark tables of the chunks that content anchors make (see ``anchors``)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from assayframe.session import settle

from .anchors import Chunks
from .text import SLICE_BYTES, Words, map_arrow, slices, word_units

#: Stands for a null key, so that keys can be joined.
NO_KEY = -(1 << 63)


def keyed(docs: DataFrame, key: str, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc, print, text, own_key, keep_...): rows by a key without nulls and a hash of the text,
    so that rows with one key but different texts stay apart."""
    full = F.coalesce(docs[text], F.lit(""))
    return docs.select(F.coalesce(docs[key].cast("long"), F.lit(NO_KEY)).alias("doc"),
                       F.xxhash64(full).alias("print"), full.alias("text"),
                       docs[key].cast("long").alias("own_key"),
                       *[docs[c].alias(f"keep_{c}") for c in keep])


def unkeyed(key: str, keep: tuple[str, ...]) -> list[Column]:
    return [F.col("own_key").alias(key), *[F.col(f"keep_{c}").alias(c) for c in keep]]


def _long(data: np.ndarray, window: int, gram: int, words: bool):
    """(first unit, chunks) of one long text, in overlapping slices, so that no window is lost
    at a border. Equal windows meet whatever the slices they lie in."""
    if not words:
        units, step = data, SLICE_BYTES
    else:
        units, step = word_units(data), SLICE_BYTES // 8
    for i in range(0, max(1, len(units) - window + 1), step):
        part = units[i:i + step + window - 1]
        yield i, Chunks(part, np.array([0, len(part)]), window, gram)


def chunk_rows(docs: DataFrame, window: int, gram: int, words: bool) -> DataFrame:
    """(anchor, content, doc, print, start, count) of each chunk of words or bytes; ``anchor``
    is its key."""

    def run(batch: pa.RecordBatch):
        doc, print_ = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for row, data, at in slices(batch.column(2)):
            if len(data) > 2 * SLICE_BYTES:
                found = _long(data, window, gram, words)
            elif words:
                read = Words(data, at)
                found = [(0, Chunks(read.hashes(), read.first, window, gram))]
            else:
                found = [(0, Chunks(data, at, window, gram))]
            for begin, c in found:
                if len(c.start):
                    yield [c.key.view(np.int64), c.content.view(np.int64), doc[row + c.doc],
                           print_[row + c.doc], c.local + begin, c.count]

    return map_arrow(docs.select("doc", "print", "text"), run,
                     "anchor long, content long, doc long, print long, start long, count long")


def repeated_chunks(docs: DataFrame, window: int, gram: int,
                    words: bool) -> tuple[DataFrame, DataFrame]:
    """(all chunks whose key occurs twice, their kinds: anchor, content, n, at).

    ``at`` is the first place (doc, print, start, count) of a kind of chunk, ``n`` how often it
    occurs. The chunks are computed twice rather than written: most keys occur once.
    """
    often = settle(chunk_rows(docs, window, gram, words).groupBy("anchor")
                   .agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "anchors")
    met = settle(chunk_rows(docs, window, gram, words).join(often, "anchor", "left_semi"),
                 "chunks")
    kinds = settle(met.groupBy("anchor", "content").agg(
        F.count("*").alias("n"), F.min(F.struct("doc", "print", "start", "count")).alias("at")),
        "kinds")
    return met, kinds


def mixed_kinds(kinds: DataFrame) -> DataFrame:
    """The kinds of keys with several kinds: anchor, content, n, kinds, doc, print, start,
    count."""
    mixed = settle(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1"),
                   "mixed")
    return kinds.join(mixed, "anchor").select("anchor", "content", "n", "kinds", "at.*")
