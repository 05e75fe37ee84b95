"""Labelled rows that the classifiers are fitted on, all of them or a bounded sample, and the
pass that scores texts."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .text import slices

#: Bytes of texts that a classifier takes at once: it makes some 25 bytes of each.
SCORED_BYTES = 500_000

#: Columns that a classifier adds.
NAMES = ("held_out", "score", "predicted")


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; 0 for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % modulus, F.lit(0))


def _free(labels: DataFrame, label: str, key: str, modulus: int, held: int) -> DataFrame:
    """(_key, _label) of labelled keys that aren't held out. Null keys and labels are left out;
    of a key with several labels the lowest counts."""
    return labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)) \
        .where(remainder(key, modulus) != held) \
        .groupBy(F.col(key).alias("_key")).agg(F.min(label).cast("int").alias("_label"))


def _one_each(found: DataFrame) -> DataFrame:
    """Of a key with several texts the one with the least hash, merged before the shuffle."""
    return found.groupBy(F.col("_key").cast("long").alias("key"), F.col("_label").alias("label")) \
        .agg(F.min_by("_text", F.xxhash64("_text")).alias("text")).select("key", "text", "label")


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, key: str, modulus: int,
                  held: int, text: str = "text") -> DataFrame:
    """(key, text, label) of all labelled rows of keys that aren't held out, as
    ``labelled_sample`` has them. Texts of keys held out are left behind before the join."""
    found = docs.where(remainder(key, modulus) != held).select(
        docs[key].alias("_doc"), F.coalesce(docs[text], F.lit("")).alias("_text"))
    return _one_each(found.join(_free(labels, label, key, modulus, held), F.expr("_doc = _key")))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, key: str, modulus: int,
                    held: int, per_class: int, text: str = "text") -> DataFrame:
    """(key, text, label) of up to ``per_class`` rows of each class, the first by a hash of the
    key, of keys that aren't held out. The sample's keys are bounded by ``per_class``, so they
    are broadcast and the texts are read in one narrow pass. Null keys and labels are left
    out; of a key with several labels the lowest counts, of a key with several texts the one
    with the least hash, merged before the shuffle."""
    free = _free(labels, label, key, modulus, held)
    order = [F.xxhash64(F.col("_key").cast("string")), F.col("_key")]
    chosen = free.where("_label = 0").orderBy(*order).limit(per_class).union(
        free.where("_label = 1").orderBy(*order).limit(per_class))
    found = docs.select(docs[key].alias("_doc"), F.coalesce(docs[text], F.lit("")).alias("_text")) \
        .join(F.broadcast(chosen), F.expr("_doc = _key"))
    return _one_each(found)


def add_score(docs: DataFrame, text: str, name: str,
              score: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """``docs`` and a double column more, ``score`` of the bytes and offsets of a slice of texts.
    Rows are sent back slice by slice, so neither side holds a batch's texts again."""
    place, names = docs.columns.index(text), [*docs.columns, name]

    def run(batches):
        for batch in batches:
            for row, data, at in slices(batch.column(place), SCORED_BYTES):
                part = batch.slice(row, len(at) - 1)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(score(data, at), pa.float64())], names=names)

    return docs.mapInArrow(run, docs.withColumn(name, F.lit(0.0)).schema)
