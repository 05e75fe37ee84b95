"""Splits and routes of validated or rule-tagged rows, and batch decisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .rules import Rule, tagged


def validated(df: DataFrame) -> DataFrame:
    """Records that passed, with or without warnings."""
    return df.where(F.col("_validation.status").isin("PASS", "WARNING"))


def flagged(df: DataFrame, record_id: str = "record_id") -> DataFrame:
    """Validation results with a warning or an error."""
    return df.where(F.col("_validation.status").isin("WARNING", "FAIL")).select(
        record_id, "_validation.*")


def strip_validation(df: DataFrame) -> DataFrame:
    return validated(df).drop("_validation")


def route_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows with the rules they break in ``violated`` and ``route`` processed or rejected."""
    return tagged(df, rules).withColumn(
        "route", F.when(F.size("violated") == 0, "processed").otherwise("rejected"))


def gate_decision(score: DataFrame, observations: DataFrame, least_score: float = 0.90) -> DataFrame:
    """Per table and run: pass when the share of passed rules reaches the threshold and
    nothing was observed, else quarantine. Both inputs have one row per rule or metric."""
    seen = observations.groupBy("table_name", "run_id").agg(F.count("*").alias("observations"))
    share = F.try_divide(F.col("rules_passed"), F.col("total_rules"))
    return (score.join(seen, ["table_name", "run_id"], "left")
            .withColumn("observations", F.coalesce("observations", F.lit(0)))
            .withColumn("decision", F.when((share >= least_score) & (F.col("observations") == 0),
                                           "pass").otherwise("quarantine")))
