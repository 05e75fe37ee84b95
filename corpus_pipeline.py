"""The corpus pipeline: stages over ``documents``, each written and read again.

A stage is (name, function); a function takes (spark, docs, sf_dir) and returns a frame. All
but the last return the columns of ``docs``. Nulls, empty texts and empty tables pass as the
operators say; documents that only lose text stay, however little is left. Repeated rows are
judged alike by the classifiers, and the near-duplicate stage keeps one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from assayframe.llm import packing, quality, simhash, suffixdedup, toxicity
from assayframe.session import fresh_path


#: Columns of the classifiers, under names that documents don't have.
_ADDED = ("stage_held_out", "stage_score", "stage_predicted")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject."""
    scored = toxicity.classify(docs, _labels(spark, sf_dir), names=_ADDED)
    return scored.where(F.col(_ADDED[2]) == 0).select(*docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    scored = quality.classify(docs, _labels(spark, sf_dir), names=_ADDED)
    return scored.where(F.col(_ADDED[2]) == 1).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints (3-word shingles) are linked by
    three differing bits or fewer, the one with the least doc_id."""
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that repeated strings of 200 bytes cover. Bytes of a character
    that a cut goes through are dropped; ``n_chars`` is counted anew."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    cut = suffixdedup.remove_repeats(docs, keep=others, as_text=True)
    named = cut.withColumn("text", F.col("kept")).withColumn(
        "n_chars", F.length("kept").cast(docs.schema["n_chars"].dataType))
    return named.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bin of each piece of a document."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("simhash", drop_near_duplicates),
    ("suffix", cut_repeats),
    ("packing", pack),
]

#: Trained classifiers and suffix sorting are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
