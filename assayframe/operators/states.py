"""Mergeable statistics: the state of two parts of a table, merged, is that of the whole.

A state is one row per column: counts, moments, bounds, lengths and a distinct-value sketch
(HyperLogLog, as bytes). States of files, days or tasks are kept and merged by Spark's own
aggregates; a run reads the rows it hasn't seen and a few rows of state, never the whole history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.predicates import missing

#: Base-2 logarithm of a sketch's buckets; few values are counted exactly.
SKETCH_BITS = 12
_ADDED = ("rows", "gaps", "n", "longer")


def states(df: DataFrame, by: list[str] | None = None, bits: int = SKETCH_BITS) -> DataFrame:
    """(by..., column, rows, gaps, n, mean, m2, low, high, shortest, longest, longer, sketch):
    one row per column (and group), from one scan. Bounds are of numbers, lengths of texts
    (``longer`` is their sum)."""
    found = []
    for f in df.schema.fields:
        if f.name in (by or []):
            continue
        col = F.col(f"`{f.name}`")
        number, text = isinstance(f.dataType, T.NumericType), isinstance(f.dataType, T.StringType)
        x = col.cast("double") if number else F.lit(None).cast("double")
        size = F.length(col).cast("long") if text else F.lit(None).cast("long")
        known = F.count(x) if number else F.count(size)
        countable = not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
        sketch = F.hll_sketch_agg(F.when(col.isNotNull(), F.xxhash64(col)), F.lit(bits)) \
            if countable else F.lit(None).cast("binary")
        found.append(F.struct(
            F.lit(f.name).alias("column"), F.count("*").alias("rows"),
            F.count_if(missing(col, f.dataType)).alias("gaps"),
            known.alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"),
            F.min(x).alias("low"), F.max(x).alias("high"), F.min(size).alias("shortest"),
            F.max(size).alias("longest"), F.sum(size).alias("longer"), sketch.alias("sketch")))
    grouped = df.groupBy(*by) if by else df.groupBy()
    return grouped.agg(F.array(*found).alias("s")).select(*(by or []), F.inline("s"))


def merge(parts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The states of all parts together, per column (and group). Moments are merged about the
    common mean, so nothing cancels out."""
    key = [*(by or []), "column"]
    rows = parts.select(*key, *[c for c in parts.columns if c not in key])
    centre = (F.sum(F.col("n") * F.col("mean")) / F.nullif(
        F.sum(F.when(F.col("mean").isNotNull(), F.col("n"))), F.lit(0))).alias("centre")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    on = same[0]
    for s in same[1:]:
        on = on & s
    means = rows.groupBy(*[F.col(c).alias(f"_{c}") for c in key]).agg(centre)
    return rows.join(means, on).groupBy(*key).agg(
        *[F.sum(c).alias(c) for c in _ADDED], F.max("centre").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("centre")) ** 2).alias("m2"),
        F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("shortest").alias("shortest"), F.max("longest").alias("longest"),
        F.hll_union_agg("sketch").alias("sketch")).select(*key, "rows", "gaps", "n", "mean", "m2",
                                                          "low", "high", "shortest", "longest",
                                                          "longer", "sketch")


def metrics_of(state: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by..., metric, value) of states: what analyzers give, with estimated distinct counts."""
    def metric(name: str, value: Column) -> Column:
        return F.struct(F.concat(F.lit("Column."), F.col("column"), F.lit(f".{name}")).alias("metric"),
                        value.cast("double").alias("value"))

    text, number = F.col("shortest").isNotNull(), F.col("mean").isNotNull()
    listed = F.array(
        metric("Completeness", F.coalesce(F.try_divide(F.col("rows") - F.col("gaps"), "rows"),
                                          F.lit(0.0))),
        F.when(F.col("sketch").isNotNull(),
               metric("DistinctValuesCount", F.hll_sketch_estimate("sketch"))),
        F.when(text, metric("MinimumLength", F.col("shortest"))),
        F.when(text, metric("MaximumLength", F.col("longest"))),
        F.when(text, metric("AverageLength", F.col("longer") / F.col("n"))),
        F.when(number, metric("Mean", F.col("mean"))),
        F.when(number & (F.col("n") > 1),
               metric("StandardDeviation", F.sqrt(F.col("m2") / (F.col("n") - 1)))))
    group = by or []
    rows = state.groupBy(*group).agg(F.max("rows").cast("double").alias("value")).select(
        *group, F.lit("Dataset.*.RowCount").alias("metric"), "value")
    return rows.unionByName(state.select(*group, F.explode(listed).alias("m"))
                            .where("m IS NOT NULL").select(*group, "m.*"))


# --- running bounds ----------------------------------------------------------------------

_HISTORY = ("table_name string, metric string, runs bigint, mean double, m2 double, low double, "
            "high double")


def no_history(spark) -> DataFrame:
    return spark.createDataFrame([], _HISTORY)


def observe(history: DataFrame, run: DataFrame, width: float = 3.0,
            least_runs: int = 5) -> tuple[DataFrame, DataFrame]:
    """(observations, history) of one run's metrics (table_name, run_id, run_ts, metric, value),
    with one row of history per metric: the verdict of ``analyzers.observations`` without reading
    earlier runs. The new history counts the run; a null value counts as no run."""
    h = history.withColumnsRenamed({"table_name": "_t", "metric": "_m"})
    joined = run.join(h, (F.col("table_name") == F.col("_t")) & (F.col("metric") == F.col("_m")),
                      "full")
    flat = F.col("low") == F.col("high")
    expected = F.when(flat, F.col("low")).otherwise(F.col("mean"))
    spread = F.when(flat, 0.0).otherwise(width * F.sqrt(F.col("m2") / (F.col("runs") - 1)))
    seen = joined.where(F.col("runs") >= least_runs).select(
        "table_name", "run_id", "run_ts", "metric", F.col("value").alias("actual"),
        expected.alias("expected"), (expected - spread).alias("lower"),
        (expected + spread).alias("upper")) \
        .where(~F.col("actual").between(F.col("lower"), F.col("upper")))
    old, value = F.coalesce("runs", F.lit(0).cast("long")), F.col("value")
    runs = old + value.isNotNull().cast("long")
    step = value - F.coalesce("mean", F.lit(0.0))
    mean = F.coalesce("mean", F.lit(0.0)) + step / F.nullif(runs, F.lit(0))
    new = joined.select(
        F.coalesce("table_name", "_t").alias("table_name"),
        F.coalesce("metric", "_m").alias("metric"), runs.alias("runs"),
        F.when(value.isNull(), F.col("mean")).otherwise(mean).alias("mean"),
        F.when(value.isNull(), F.col("m2")).otherwise(
            F.coalesce("m2", F.lit(0.0)) + step * (value - mean)).alias("m2"),
        F.least("low", value).alias("low"), F.greatest("high", value).alias("high"))
    return seen, new
