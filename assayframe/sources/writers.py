"""Writers: JSON Lines, reports, partitioned rule results, validation outputs, metrics."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import metrics as m, routing, rules, summaries
from .readers import RECORD_SCHEMA, read_json_array


def write_json_lines(df: DataFrame, path: str) -> None:
    """One object per line, nulls and non-ASCII text kept."""
    df.write.option("ignoreNullFields", False).json(path)


def write_json_arrays(df: DataFrame, path: str) -> None:
    """A JSON array per file, one file per task; rows are written as they come."""
    lines = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
                      .alias("value"))

    def bracketed(batches):
        begun = False
        for batch in batches:
            if batch.num_rows:
                rows = batch.column(0).to_pylist()
                rows = [f", {r}" for r in rows] if begun else \
                    [f"[ {rows[0]}", *(f", {r}" for r in rows[1:])]
                begun = True
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]" if begun else "[]"])], names=["value"])

    lines.mapInArrow(bracketed, "value string").write.text(path)


def array_to_lines(spark: SparkSession, source: str, target: str,
                   schema: str = RECORD_SCHEMA) -> None:
    """JSON array files to JSON Lines, which later reads can split."""
    write_json_lines(read_json_array(spark, source, schema), target)


def write_report(results: DataFrame, path: str) -> None:
    """Rule results by table, and the scores per table and in total."""
    results.write.partitionBy("table_name").parquet(f"{path}/rule_results")
    kept = results.sparkSession.read.schema(results.schema).parquet(f"{path}/rule_results")
    rules.score_all(kept).write.json(f"{path}/summary")


#: What a rule of each type measures; other types measure a count of rows.
_MEASURED = {"Completeness": "Completeness", "Range": "Compliance", "RegexMatch": "Compliance",
             "Format": "Compliance", "ValueSet": "Compliance", "ColumnLength": "Compliance",
             "NestedRange": "Compliance", "Consistency": "Compliance",
             "Uniqueness": "Uniqueness"}


def evaluated_metrics() -> Column:
    """A rule's measures by name: its own metric, the values checked and those that offend."""
    column = F.coalesce(F.concat(F.lit("Column."), F.col("column")), F.lit("Dataset.*"))
    kind = F.lit("Value")
    for rule_type, measured in _MEASURED.items():
        kind = F.when(F.col("type") == rule_type, measured).otherwise(kind)
    kind = F.when(F.col("type") == "RowCount", "RowCount").otherwise(kind)

    def named(name, value):
        return F.struct(F.concat(column, F.lit("."), name).alias("key"),
                        value.cast("double").alias("value"))

    measures = F.array(named(kind, F.col("metric")), named(F.lit("Checked"), F.col("checked")),
                       named(F.lit("Violations"), F.col("violations")))
    return F.map_from_entries(F.filter(measures, lambda m: m["value"].isNotNull()))


def write_results(results: DataFrame, path: str, run_ts) -> None:
    """One JSON line per rule, partitioned by table and run day; one file per table and run."""
    day = F.lit(run_ts).cast("timestamp")
    (results.select(
        "table_name", F.date_format(day, "yyyy").alias("year"),
        F.date_format(day, "MM").alias("month"), F.date_format(day, "dd").alias("day"),
        "run_id", "rule", "outcome",
        F.when(F.col("outcome") != "PASS", F.concat(
            F.lit("metric "), F.coalesce(F.col("metric").cast("string"), F.lit("not available")),
            F.lit(" does not meet the rule"))).alias("failure_reason"),
        evaluated_metrics().alias("evaluated_metrics"))
     .repartition("table_name")
     .write.mode("append").partitionBy("table_name", "year", "month", "day")
     .option("ignoreNullFields", False).json(path))


RESULT_LINES = ("run_id string, rule string, outcome string, failure_reason string, "
                "evaluated_metrics map<string,double>, table_name string, year string, "
                "month string, day string")


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESULT_LINES).json(path)


def write_validation(validated: DataFrame, path: str, record_id: str = "record_id") -> DataFrame:
    """Summary, issue counts by type, flagged results, gate summary and clean records under
    ``path``.

    The validated frame is written once and read back for the five outputs, so that the
    checks run once and a lost executor costs no more than its own tasks.
    """
    spark = validated.sparkSession
    validated.write.parquet(f"{path}/all")
    kept = spark.read.schema(validated.schema).parquet(f"{path}/all")
    summaries.validation_summary(kept).write.json(f"{path}/validation_summary")
    summaries.errors_by_type(kept).write.json(f"{path}/errors_by_type")
    summaries.gate_summary(kept).write.json(f"{path}/gate_summary")
    routing.flagged(kept, record_id).write.parquet(f"{path}/flagged")
    routing.strip_validation(kept).write.parquet(f"{path}/clean")
    return kept


def write_routes(routed: DataFrame, path: str) -> None:
    routed.write.partitionBy("route").parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Batches of metrics, each with namespace, count and members."""
    batched = m.batches(metrics)
    (batched.groupBy("namespace", "batch_id")
     .agg(F.count("*").alias("metric_count"),
          F.collect_list(F.struct("name", "value", "unit", "ts", "dimensions")).alias("metrics"))
     .write.json(path))
