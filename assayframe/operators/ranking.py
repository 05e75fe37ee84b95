"""Row positions without a task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import settle


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[str],
                into: str = "position") -> DataFrame:
    """1-based position of each row in its group, or in the whole frame for no group.

    Rows are range-partitioned on group and order, so a group of any size is spread
    over tasks; each task numbers its part, and the parts' sizes (one row per task and
    group) give the offsets. The split is written once so both reads agree on it.
    """
    group, order = list(group), list(order)
    split = settle(df.withColumn("_tie", F.monotonically_increasing_id())
                   .repartitionByRange(*group, *order, "_tie")
                   .withColumn("_part", F.spark_partition_id()), "numbered")
    sizes = split.groupBy(*group, "_part").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
                           F.col("_part").alias("_p"),
                           F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    inside = Window.partitionBy(*group, "_part").orderBy(*order, "_tie")
    return (split.withColumn("_local", F.row_number().over(inside))
            .join(offsets, same)
            .withColumn(into, F.col("_local") + F.col("_before"))
            .select(*df.columns, into))
