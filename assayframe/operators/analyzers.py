"""Statistics without a verdict, rule recommendation, and anomalies over run history."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.predicates import field_type, missing
from ..functions.sql import name as quote


@dataclass(frozen=True)
class Analyzer:
    """``kind`` is one of row_count, completeness, length, distinct, mean, stddev."""

    kind: str
    column: str | None = None
    approximate: bool = False


def _fused(analyzer: Analyzer, schema: T.StructType) -> dict[str, Column]:
    name = analyzer.column
    if analyzer.kind == "row_count":
        return {"Dataset.*.RowCount": F.count("*").cast("double")}
    dtype, col, stem = field_type(schema, name), F.col(name), f"Column.{name}"
    if analyzer.kind == "completeness":
        share = F.try_divide(F.count_if(~missing(col, dtype)), F.count("*"))
        return {f"{stem}.Completeness": F.coalesce(share, F.lit(0.0))}
    if analyzer.kind == "length":
        size = F.length(col.cast("string"))
        return {f"{stem}.MinimumLength": F.min(size).cast("double"),
                f"{stem}.MaximumLength": F.max(size).cast("double"),
                f"{stem}.AverageLength": F.avg(size)}
    if analyzer.kind == "mean":
        return {f"{stem}.Mean": F.avg(col).cast("double")}
    if analyzer.kind == "stddev":
        return {f"{stem}.StandardDeviation": F.stddev_samp(col).cast("double")}
    if analyzer.kind == "distinct" and analyzer.approximate:
        return {f"{stem}.DistinctValuesCount": F.approx_count_distinct(col).cast("double")}
    raise ValueError(f"unknown analyzer {analyzer.kind}")


def analyze(df: DataFrame, analyzers: Sequence[Analyzer], table_name: str, run_id: str = "",
            run_ts=None) -> DataFrame:
    """(table_name, run_id, run_ts, metric, value) rows.

    Everything but exact distinct counts comes out of one aggregation. An exact
    distinct count reads its one column and shuffles only the values that are left
    after each task has merged its own; several in one aggregation would instead
    multiply every row by their number.
    """
    measures: dict[str, Column] = {}
    exact = []
    for analyzer in analyzers:
        if analyzer.kind == "distinct" and not analyzer.approximate:
            exact.append(analyzer.column)
        else:
            measures.update(_fused(analyzer, df.schema))
    frames = []
    if measures:
        pairs = [F.struct(F.lit(m).alias("metric"), v.alias("value"))
                 for m, v in measures.items()]
        frames.append(df.agg(F.array(*pairs).alias("m")).select(F.inline_outer("m")))
    for name in exact:
        values = df.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("v")).agg(F.lit(1))
        frames.append(values.agg(F.lit(f"Column.{name}.DistinctValuesCount").alias("metric"),
                                 F.count("*").cast("double").alias("value")))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out.select(F.lit(table_name).alias("table_name"), F.lit(run_id).alias("run_id"),
                      F.lit(run_ts).cast("timestamp").alias("run_ts"), "metric", "value")


# --- recommendation --------------------------------------------------------------------

#: A text column with at most so many values gets a value set, unless the caller says else.
VALUE_SET_SIZE = 20


#: Values are hashed below this prime to check that a summary of them is whole.
_CHECK = 1048573


def _few_values(column: str, most: int) -> Column:
    """The distinct values of a text column if there are ``most`` at most, else null.

    A frequent-items summary of fixed size, merged like any aggregate. It counts exactly until
    more values come than it tracks; its counts then no longer add up to the rows, by number and
    by hash, so no estimate ever decides.
    """
    value = quote(column)
    k = most + 1
    top = (f"approx_top_k({value}, {k}, {4 * k}) FILTER (WHERE {value} IS NOT NULL)")
    check = f"pmod(xxhash64({value}), {_CHECK}L)"
    return F.expr(f"named_struct('top', {top}, 'n', count({value}), "
                  f"'check', sum(CASE WHEN {value} IS NOT NULL THEN {check} END))")


def _whole_values(few: Column, most: int) -> Column:
    top = few["top"]
    zero = F.lit(0).cast("bigint")
    number = F.aggregate(top, zero, lambda a, x: a + x["count"])
    check = F.aggregate(top, zero, lambda a, x: a + x["count"] * F.pmod(
        F.xxhash64(x["item"]), F.lit(_CHECK)))
    whole = (few["n"] > 0) & (F.size(top) <= most) & (number == few["n"]) & (check == few["check"])
    return F.when(whole, F.transform(top, lambda x: x["item"]))


def _profile_columns(df: DataFrame, value_set_size: int) -> list[Column]:
    profiled = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        numeric = isinstance(f.dataType, T.NumericType)
        text = isinstance(f.dataType, T.StringType)
        none = F.lit(None).cast("double")
        # Bounds keep their type and digits; what is not a number is no bound.
        real = F.when(~F.isnan(col), col) if isinstance(
            f.dataType, (T.DoubleType, T.FloatType)) else col
        size = F.length(col)
        profiled.append(F.struct(
            F.lit(f.name).alias("column"),
            F.lit("number" if numeric else "text" if text else "other").alias("kind"),
            F.count("*").alias("rows"),
            F.count_if(missing(col, f.dataType)).alias("gaps"),
            (F.min(real) if numeric else F.lit(None)).cast("string").alias("low"),
            (F.max(real) if numeric else F.lit(None)).cast("string").alias("high"),
            (F.stddev_samp(real).cast("double") if numeric else none).alias("spread"),
            (F.min(size) if text else F.lit(None)).cast("long").alias("shortest"),
            (F.max(size) if text else F.lit(None)).cast("long").alias("longest"),
            (_few_values(f.name, value_set_size) if text else F.lit(None)).cast(
                "struct<top:array<struct<item:string,count:bigint>>,n:bigint,check:bigint>")
            .alias("few"),
        ))
    return profiled


def profile(df: DataFrame, value_set_size: int = VALUE_SET_SIZE) -> DataFrame:
    """One row per column, from one scan; ``values`` are those of a text column with few."""
    found = df.agg(F.array(*_profile_columns(df, value_set_size)).alias("p")) \
        .select(F.inline_outer("p"))
    return found.withColumn("values", _whole_values(F.col("few"), value_set_size)).drop("few")


def _spread_text(value: Column) -> Column:
    """Two digits where they tell enough, else seven significant ones."""
    return F.when(value.between(0.1, 1e9), F.format_string("%.2f", value)).otherwise(
        F.format_string("%.6e", value))


def recommend(df: DataFrame, value_set_size: int = VALUE_SET_SIZE) -> DataFrame:
    """Candidate rules for a table, as (column, type, rule).

    IsComplete where nothing is missing; observed bounds at 0.95 and a spread band of
    0.75 to 1.25 for numbers; observed lengths at 0.99 for text; a value set for text
    with up to ``value_set_size`` values; a row-count band of half to one and a half.

    One scan, and nothing runs before the result is asked for.
    """
    columns = profile(df, value_set_size)
    number, text = F.col("kind") == "number", F.col("kind") == "text"
    quoted = F.concat(F.lit('"'), F.col("column"), F.lit('"'))
    listed = F.array_join(F.sort_array(F.transform("values", lambda v: F.concat(
        F.lit('"'), v, F.lit('"')))), ", ")

    def rule(kind, body):
        return F.struct(F.lit(kind).alias("type"), body.alias("rule"))

    candidates = F.array(
        F.when(F.col("gaps") == 0, rule("Completeness", F.concat(F.lit("IsComplete "), quoted))),
        F.when(number & F.col("low").isNotNull(), rule("Range", F.concat(
            F.lit("ColumnValues "), quoted, F.lit(" between "),
            F.col("low"), F.lit(" and "), F.col("high"), F.lit(" with threshold >= 0.95")))),
        F.when(number & F.col("spread").isNotNull(), rule("Statistical", F.concat(
            F.lit("StandardDeviation "), quoted, F.lit(" between "),
            _spread_text(F.col("spread") * 0.75), F.lit(" and "),
            _spread_text(F.col("spread") * 1.25)))),
        F.when(text & F.col("shortest").isNotNull(), rule("ColumnLength", F.concat(
            F.lit("ColumnLength "), quoted, F.lit(" between "), F.col("shortest").cast("string"),
            F.lit(" and "), F.col("longest").cast("string"),
            F.lit(" with threshold >= 0.99")))),
        F.when(F.col("values").isNotNull(), rule("ValueSet", F.concat(
            F.lit("ColumnValues "), quoted, F.lit(" in ["), listed, F.lit("]")))),
        # The first column's row tells the table's rows.
        F.when(F.col("column") == df.columns[0], rule("RowCount", F.concat(
            F.lit("RowCount between "), F.floor(F.col("rows") * 0.5).cast("string"),
            F.lit(" and "), F.ceil(F.col("rows") * 1.5).cast("string")))),
    )
    table = F.col("r.type") == "RowCount"
    return columns.select("column", F.explode_outer(candidates).alias("r")).where("r is not null") \
        .select(F.when(~table, F.col("column")).alias("column"), "r.*")


def rules_diff(recommended: DataFrame, written: DataFrame) -> DataFrame:
    """Rule texts of both sides with ``side`` both, recommended or written."""
    left, right = recommended.select("rule").distinct(), written.select("rule").distinct()
    return (left.intersect(right).withColumn("side", F.lit("both"))
            .unionByName(left.exceptAll(right).withColumn("side", F.lit("recommended")))
            .unionByName(right.exceptAll(left).withColumn("side", F.lit("written"))))


# --- run history -----------------------------------------------------------------------

def observations(history: DataFrame, width: float = 3.0, least_runs: int = 5) -> DataFrame:
    """Metric values outside mean +- ``width`` sample deviations of all earlier runs.

    Needs ``least_runs`` earlier runs. With no spread so far, any change is observed.
    """
    earlier = (Window.partitionBy("table_name", "metric").orderBy("run_ts", "run_id")
               .rowsBetween(Window.unboundedPreceding, -1))
    # The mean of equal values is rounded, so they are told by their bounds.
    low, high = F.min("value").over(earlier), F.max("value").over(earlier)
    expected = F.when(low == high, low).otherwise(F.avg("value").over(earlier))
    spread = F.when(low == high, 0.0).otherwise(width * F.stddev_samp("value").over(earlier))
    return (history
            .select("table_name", "run_id", "run_ts", "metric", F.col("value").alias("actual"),
                    expected.alias("expected"), (expected - spread).alias("lower"),
                    (expected + spread).alias("upper"),
                    F.count("value").over(earlier).alias("runs"))
            .where((F.col("runs") >= least_runs)
                   & ~F.col("actual").between(F.col("lower"), F.col("upper")))
            .drop("runs"))


def latest_result(scores: DataFrame) -> DataFrame:
    """The newest run per table."""
    newest = F.max_by(F.struct(*[c for c in scores.columns if c != "table_name"]),
                      F.struct("run_ts", "run_id"))
    return scores.groupBy("table_name").agg(newest.alias("n")).select("table_name", "n.*")


def has_result(scores: DataFrame, table_name: str) -> bool:
    """Whether a run of the table can be skipped because a result is there."""
    return bool(scores.where(F.col("table_name") == table_name).take(1))


def score_trend(scores: DataFrame) -> DataFrame:
    by_run = Window.partitionBy("table_name").orderBy("run_ts", "run_id")
    before = F.lag("score").over(by_run)
    return scores.withColumn("previous", before).withColumn("change", F.col("score") - before)
