"""Write, audit, publish: a batch is seen by readers as a whole and after its verdict, or not.

A batch is written once to a folder of its own try, which no reader looks at. It is audited
there, from the files that will be published. Publishing writes one row that names the folder;
readers follow these rows. A run that ends in between leaves a folder nobody reads, and a batch
that is run again publishes its newest try in place of the one before.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

_ROW = "path string, decision string, score double"


def stage(df: DataFrame, folder: str, batch: int) -> str:
    """Writes a batch unseen; returns its folder."""
    path = f"{folder}/staged/batch={batch}/try={uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def publish(spark: SparkSession, folder: str, batch: int, path: str, decision: str,
            score: float | None = None) -> None:
    """Makes a staged batch visible under a decision: one row in one file."""
    spark.createDataFrame([(path, decision, score)], _ROW).coalesce(1).write.mode(
        "overwrite").parquet(f"{folder}/manifest/batch={batch}")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(path, decision, score, batch) of the published batches."""
    try:
        return spark.read.parquet(f"{folder}/manifest")
    except AnalysisException:  # nothing published yet
        return spark.createDataFrame([], _ROW + ", batch int")


def published(spark: SparkSession, folder: str, decision: str | None = None,
              schema: str | None = None) -> DataFrame | None:
    """The rows of published batches with their ``batch`` and ``decision``; None if there are
    no batches. Only the folders that the manifest names are read: a row per batch reaches the
    driver, as its files' names do."""
    rows = manifest(spark, folder)
    if decision is not None:
        rows = rows.where(F.col("decision") == decision)
    listed = rows.select("path", "decision", "batch").collect()
    if not listed:
        return None
    reader = spark.read.option("basePath", f"{folder}/staged")
    found = (reader.schema(schema + ", batch int, try string") if schema else reader).parquet(
        *[r["path"] for r in listed]).drop("try")
    told = spark.createDataFrame([(r["batch"], r["decision"]) for r in listed],
                                 "_batch int, decision string")
    return found.join(F.broadcast(told), F.col("batch") == F.col("_batch")).drop("_batch")
