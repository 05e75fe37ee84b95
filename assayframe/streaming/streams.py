"""Streams: validation, quality gate, alarm periods, late data and last-wins updates.

Every stream reads files, keeps its progress in a checkpoint folder and writes files, so
it can be stopped and started again and loses nothing with an executor. ``once`` runs it
over all files there are and returns.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators import analyzers, metrics, rules, states, validation
from ..operators.gates import GatePatterns
from ..sources import publishing


def read_files(spark: SparkSession, path: str, schema, fmt: str = "parquet",
               files_per_batch: int | None = None, **options) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def once(query: StreamingQuery) -> StreamingQuery:
    """Waits for a stream with ``availableNow`` to end, and raises what it failed with."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return query


def validate_stream(records: DataFrame, target: str, checkpoint: str, level: str = "full",
                    as_of=None, note: str | None = None,
                    patterns: GatePatterns = GatePatterns(), **trigger) -> StreamingQuery:
    """Validated records as they arrive. Stateless: the same Columns as the batch form, and
    nothing is shuffled."""
    out = validation.validate(records, level, as_of, note, patterns=patterns)
    return (out.writeStream.format("parquet").option("path", target)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or _NOW)).start())


_NOW = {"availableNow": True}


def gate_stream(records: DataFrame, ruleset: Sequence[rules.Rule], table_name: str, target: str,
                checkpoint: str, least_score: float = 0.90,
                watched: Sequence[analyzers.Analyzer] = (), history: str | None = None,
                width: float = 3.0, **trigger) -> StreamingQuery:
    """Writes each batch, audits what was written, and publishes it with its decision, pass or
    quarantine (see ``publishing``). ``gated`` reads published batches.

    A batch passes when enough of its rules do and its ``watched`` metrics are not out of line
    with those of earlier batches, of which the folder ``history`` keeps one row per metric and
    batch. What was out of line is kept for review with its expected value and limits
    (``reviews``). The decision is one row; it is the only thing that reaches the driver.
    """
    if watched and history is None:
        raise ValueError("watched metrics need a folder for their history")

    def route(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = publishing.stage(batch, target, batch_id)
        staged = spark.read.schema(batch.schema).parquet(path)
        results = rules.evaluate(staged, ruleset, table_name, str(batch_id))
        score = rules.score(results).first()
        good = score["rules_passed"] >= least_score * score["total_rules"]
        if watched:
            own = f"{target}/metrics/batch={batch_id}"
            analyzers.analyze(staged, watched, table_name, f"{batch_id:012d}").write.mode(
                "overwrite").parquet(own)
            seen, bounds = states.observe(_bounds(spark, history, batch_id),
                                          spark.read.parquet(own), width)
            seen.write.mode("overwrite").parquet(f"{target}/reviews/batch={batch_id}")
            bounds.write.mode("overwrite").parquet(f"{history}/batch={batch_id}")
            good = good and spark.read.parquet(f"{target}/reviews/batch={batch_id}").isEmpty()
        publishing.publish(spark, target, batch_id, path, "pass" if good else "quarantine",
                           score["overall_score"])

    return (records.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or _NOW)).start())


def _bounds(spark: SparkSession, history: str, batch_id: int) -> DataFrame:
    """What the batch before left of all runs so far."""
    try:
        return spark.read.parquet(f"{history}/batch={batch_id - 1}")
    except AnalysisException:
        return states.no_history(spark)


def gated(spark: SparkSession, target: str, decision: str | None = None) -> DataFrame | None:
    """The rows of published batches with ``batch`` and ``decision``."""
    return publishing.published(spark, target, decision)


def reviews(spark: SparkSession, target: str) -> DataFrame:
    """Metrics of published batches that were out of line: actual, expected, lower, upper."""
    known = publishing.manifest(spark, target).select(F.col("batch").alias("_batch"))
    return spark.read.parquet(f"{target}/reviews").join(
        F.broadcast(known), F.col("batch") == F.col("_batch"), "left_semi")  # a row per batch


def period_stream(events: DataFrame, target: str, checkpoint: str, value: Column,
                  late: str, keys: Sequence[str] = (), period: str = "300 seconds",
                  **trigger) -> StreamingQuery:
    """Count and sum per period and key. Each batch appends the periods it changed, with
    its own number; ``current`` reads the last state of each, ``compact`` merges batches.

    Events that come more than ``late`` behind the newest one seen are dropped, and their
    state is freed: choose it by how far files may be out of order, and count what is dropped
    with ``DropCounter``.
    """
    periods = (events.withWatermark("ts", late)
               .groupBy(F.window("ts", period).alias("w"), *keys)
               .agg(F.count("*").alias("n"), F.sum(value).alias("total")))

    def append(batch: DataFrame, batch_id: int) -> None:
        (batch.select(F.col("w.start").alias("period_start"), *keys, "n", "total")
         .write.mode("overwrite").parquet(f"{target}/batch={batch_id}"))

    return (periods.writeStream.outputMode("update").foreachBatch(append)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or _NOW)).start())


def current(spark: SparkSession, target: str, keys: Sequence[str],
            order: str | None = None) -> DataFrame:
    """The newest row per key over the folders of all batches: that of the last batch, or the
    one with the greatest ``order``."""
    rows = spark.read.parquet(target)
    rest = [c for c in rows.columns if c not in keys and c != "batch"]
    newest = F.max_by(F.struct(*rest), F.col(order or "batch"))
    return rows.groupBy(*keys).agg(newest.alias("_r")).select(*keys, "_r.*")


def last_wins_stream(rows: DataFrame, key: str, order: str, target: str, checkpoint: str,
                     **trigger) -> StreamingQuery:
    """The row with the greatest ``order`` per key of each batch, appended under its number.

    The stream keeps no state, so none grows: which row wins over all batches is told by
    ``order`` when they are read (``current`` with the same order) or merged (``compact``), however
    late it came. Rows are merged within tasks before they are shuffled, so a hot key is one row
    per task. ``changes`` tells what a batch changed.
    """
    rest = [c for c in rows.columns if c != key]

    def append(batch: DataFrame, batch_id: int) -> None:
        newest = batch.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r"))
        newest.select(key, "_r.*").write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (rows.writeStream.foreachBatch(append)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or _NOW)).start())


def changes(spark: SparkSession, target: str, key: str, order: str, batch: int) -> DataFrame:
    """The rows of a batch that win over all earlier ones of their key."""
    rows = spark.read.parquet(target)
    before = rows.where(F.col("batch") < batch).groupBy(F.col(key).alias("_key")).agg(
        F.max(order).alias("_before"))
    return rows.where(F.col("batch") == batch).join(before, F.col(key) == F.col("_key"), "left") \
        .where(F.col("_before").isNull() | (F.col(order) > F.col("_before"))) \
        .drop("_key", "_before", "batch")


def first_wins(rows: DataFrame, keys: Sequence[str], ts: str, late: str) -> DataFrame:
    """The first row per key within the watermark, with state that expires."""
    return rows.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def compact(spark: SparkSession, target: str, into: str, keys: Sequence[str],
            order: str | None = None, alive: Column | None = None) -> None:
    """Writes the newest row per key of all batch folders (see ``current``) as one batch of a new
    folder, with the number of the last of them, so that later batches still win. Keys whose
    newest row isn't ``alive`` (say, younger than some days) are left out. Run it between runs of
    the stream, which then goes on in the new folder with its old checkpoint."""
    last = spark.read.parquet(target).agg(F.max("batch")).first()[0]
    rows = current(spark, target, keys, order)
    if alive is not None:
        rows = rows.where(alive)
    rows.write.parquet(f"{into}/batch={last}")


def alarm_stream_states(spark: SparkSession, target: str, alarms: Sequence[metrics.Alarm],
                        key: str) -> DataFrame:
    """Alarm states over the periods a ``period_stream`` keeps by ``key``: the sums are
    readings of the metric that the key names, and periods without any count as missing."""
    readings = current(spark, target, ["period_start", key]).select(
        F.col(key).alias("name"), F.col("total").alias("value"),
        F.col("period_start").alias("ts"),
        F.create_map().cast("map<string,string>").alias("dimensions"))
    return metrics.alarm_states(readings, alarms)


class DropCounter(StreamingQueryListener):
    """Counts what watermarks dropped, for each query by its id, over every progress report;
    add it with ``spark.streams.addListener`` before the streams start. Aggregations count
    groups merged within tasks, so the number depends on how rows were dealt."""

    def __init__(self):
        self.dropped: dict[str, int] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        query = str(event.progress.id)
        self.dropped[query] = self.dropped.get(query, 0) + sum(
            op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def of(self, query: StreamingQuery, wait_s: float = 30.0) -> int:
        """What was dropped up to the end of this run of a query; reports come after it."""
        until = time.monotonic() + wait_s
        while str(query.runId) not in self.ended and time.monotonic() < until:
            time.sleep(0.05)
        return self.dropped.get(str(query.id), 0)
