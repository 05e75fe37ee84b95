"""Whole jobs: quality run, governed run, validation run, payload build."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import (
    analyzers, entities, joins, ledger, metrics, payloads, routing, rules, states, validation,
)
from ..operators.gates import GatePatterns
from ..sources import metric_sink, writers


def quality_run(tables: Mapping[str, tuple[DataFrame, Sequence[rules.Rule]]], path: str | None = None,
                run_id: str = "") -> DataFrame:
    """Rule results of several tables as one frame, and the report under ``path``."""
    results = None
    for name, (df, ruleset) in tables.items():
        one = rules.evaluate(df, ruleset, name, run_id)
        results = one if results is None else results.unionByName(one)
    if path:
        writers.write_report(results, path)
        results = results.sparkSession.read.schema(results.schema).parquet(f"{path}/rule_results")
    return results


_DECISION = ["table_name", "run_id", "rules_passed", "total_rules", "observations", "decision"]


def governed_run(spark: SparkSession, path: str, ruleset: Sequence[rules.Rule], table_name: str,
                 folder: str, run_id: str, run_ts: str, watched: Sequence[analyzers.Analyzer] = (),
                 alarms: Sequence[metrics.Alarm] = (), least_score: float = 0.90,
                 width: float = 3.0, least_runs: int = 5, fmt: str = "parquet") -> DataFrame:
    """One governed run of the table under ``path``: its rules through the ledger, its watched
    metrics against their history, a decision, the score's metrics in groups, and alarms. Returns
    the decision: one row (table_name, run_id, rules_passed, total_rules, observations, decision).

    Runs follow each other in ``folder``. An unchanged table keeps its last decision, and no data
    is read. Otherwise a run leaves, under its id, what was observed (``reviews``), one row of
    history per metric, changes of alarms and where they stand; its decision is written last and
    is what the next run goes on from. A run that ended before it is run again under a new id.
    """
    results = ledger.evaluate(spark, path, ruleset, table_name, f"{folder}/ledger", run_id, run_ts,
                              fmt)
    done = _decisions(spark, folder, table_name)
    own = results.select("run_id").first()[0]
    last = None if done is None else done.orderBy(F.desc("run_ts"), F.desc("run_id")).first()
    if last is not None and last["ledger_id"] == own:
        return done.where(F.col("run_id") == last["run_id"]).select(*_DECISION)
    stamp = F.lit(run_ts).cast("timestamp")
    score = rules.score(results).withColumn("run_id", F.lit(run_id))
    df = spark.read.format(fmt).load(path)
    seen = f"{folder}/reviews/run={run_id}"
    if watched:
        measured = f"{folder}/watched/run={run_id}"
        analyzers.analyze(df, watched, table_name, run_id, run_ts).write.mode("overwrite").parquet(
            measured)
        known = states.no_history(spark) if last is None else spark.read.parquet(
            f"{folder}/history/run={last['run_id']}")
        observed, bounds = states.observe(known, spark.read.parquet(measured), width, least_runs)
        observed.write.mode("overwrite").parquet(seen)
        bounds.write.mode("overwrite").parquet(f"{folder}/history/run={run_id}")
        observations = spark.read.parquet(seen)
    else:
        observations = score.limit(0).select("table_name", "run_id")
    feed = metrics.dq_metrics(score, stamp)
    metric_sink.write_metric_groups(feed, f"{folder}/metrics")
    if alarms:
        _alarm_run(spark, feed, alarms, folder, run_id, last)
    routing.gate_decision(score, observations, least_score).select(
        *_DECISION, F.lit(own).alias("ledger_id"), stamp.alias("run_ts")).coalesce(1) \
        .write.mode("append").parquet(f"{folder}/decisions")
    return _decisions(spark, folder, table_name).where(F.col("run_id") == run_id).select(*_DECISION)


def _decisions(spark: SparkSession, folder: str, table_name: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{folder}/decisions").where(F.col("table_name") == table_name)
    except AnalysisException:
        return None


def _alarm_run(spark, feed, alarms, folder, run_id, last) -> None:
    """Moves the alarms on to the period of this run, from where the last one left them."""
    carry = None
    if last is not None:
        try:
            carry = spark.read.parquet(f"{folder}/alarms/run={last['run_id']}")
        except AnalysisException:
            carry = None
    now = feed.agg(F.max(F.unix_seconds("ts"))).first()[0]
    changes, stand = metrics.alarm_changes(metrics.measure_alarms(feed, alarms), alarms, now, now + 1,
                                           carry)
    changes.write.mode("overwrite").parquet(f"{folder}/alarm-changes/run={run_id}")
    stand.write.mode("overwrite").parquet(f"{folder}/alarms/run={run_id}")


def validation_run(records: DataFrame, notes: DataFrame, note_order: str, path: str,
                   level: str = "full", as_of=None,
                   patterns: GatePatterns = GatePatterns()) -> DataFrame:
    """Joins notes, validates, writes the four outputs; returns the written frame."""
    joined = joins.join_notes(records, notes, note_order)
    return writers.write_validation(
        validation.validate(joined, level, as_of, "note", patterns=patterns), path)


def payload_run(records: DataFrame, validated: DataFrame, notes: DataFrame,
                note_order: str) -> DataFrame:
    """One payload per record that validation kept: (record_id, entities, payload)."""
    kept = joins.only_validated(records, routing.validated(validated))
    noted = joins.join_notes_typed(kept, notes, note_order)
    found = (entities.with_entities(noted, "note", "_entities")
             .withColumn("entities", entities.standardize(F.col("_entities"))))
    return found.select("record_id", "entities", payloads.record_payload(
        payloads.build_prompt(found)).alias("payload"))
