"""Registration of queries over the driver tables, with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Setting that says to how many tasks the rows of a scan are dealt before costly checks. The
#: caller's choice for small files, which Spark reads in one task; unset, scans stay as they are.
DEAL = "spark.assayframe.deal"


def dealt_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows are costly to check."""
    tasks = spark.conf.get(DEAL, None)
    df = table(spark, sf_dir, name)
    return df.repartition(int(tasks)) if tasks else df


def plain(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint, so that both engines report one type."""
    small = (T.ByteType, T.ShortType, T.IntegerType)
    return df.select(*[F.col(f.name).cast("bigint").alias(f.name)
                       if isinstance(f.dataType, small) else F.col(f.name)
                       for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
