"""Periods of a stream with every event accounted for, and alarms that follow them.

A batch leaves four small tables under its own number, all written anew if it is run again: the
open periods (those of the batch before, merged with its own events), its late events as they
came, the clock (how far periods are closed), and where alarms stand. What a batch needs of the
past is the last batch's tables, so its work and state are bounded by its events and by the
periods that are still open, not by the stream's age.

A period is closed once the newest event seen is ``late`` seconds past its end. An event whose
period was closed by an earlier batch, or that has no time, is late; it is kept whole. So the
kept periods and the late events add up to all events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import metrics

_NOW = {"availableNow": True}
_CLOCK = "until long, first long"


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def _clock(spark: SparkSession, target: str, batch: int) -> tuple[int | None, int | None]:
    """Seconds up to which periods were closed after a batch, and the first period ever."""
    row = _read(spark, f"{target}/clock/batch={batch}")
    return (None, None) if row is None else tuple(row.first())


def period_stream(events: DataFrame, target: str, checkpoint: str, value: Column, late_s: int,
                  keys: Sequence[str] = (), period_s: int = 300, ts: str = "ts",
                  alarms: Sequence[metrics.Alarm] = (), **trigger) -> StreamingQuery:
    """Counts, sums and bounds per period and key, late events, and changes of alarms.

    An alarm reads the periods whose first key is its metric and whose other keys are its
    dimensions; its own period is a multiple of ``period_s``. ``closed``, ``kept``, ``late`` and
    ``changes`` read the results.
    """
    for a in alarms:
        if a.period_s % period_s or not keys or not set(a.dimensions) <= set(keys[1:]):
            raise ValueError(f"{a.name}: its period or dimensions aren't those of the stream")
    place = F.floor(F.unix_seconds(F.col(ts)) / period_s) * period_s
    sums = {"n": F.sum("n"), "total": F.sum("total"), "low": F.min("low"), "high": F.max("high"),
            "valued": F.sum("valued"), "newest": F.max("newest")}

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        until, first = _clock(spark, target, number - 1)
        placed = batch.withColumn("_period", place)
        lost = F.col("_period").isNull()
        if until is not None:
            lost = lost | (F.col("_period") + period_s <= until)
        placed.where(lost).drop("_period").write.mode("overwrite").parquet(
            f"{target}/late/batch={number}")
        fresh = (placed.where(~lost).withColumn("_v", value.cast("double"))
                 .groupBy(F.col("_period").alias("period"), *keys)
                 .agg(F.count("*").alias("n"), F.sum("_v").alias("total"),
                      F.min("_v").alias("low"), F.max("_v").alias("high"),
                      F.count("_v").alias("valued"),
                      F.max(F.unix_seconds(F.col(ts))).alias("newest")))
        held = _read(spark, f"{target}/periods/batch={number - 1}")
        if held is not None:
            if until is not None:
                held = held.where(F.col("period") + period_s > until)
            fresh = held.unionByName(fresh).groupBy("period", *keys).agg(
                *[v.alias(c) for c, v in sums.items()])
        fresh.write.mode("overwrite").parquet(f"{target}/periods/batch={number}")
        newest, oldest = spark.read.parquet(f"{target}/periods/batch={number}").agg(
            F.max("newest"), F.min("period")).first()
        if newest is not None:
            # Alarms begin with the oldest period that is there when the first one is closed.
            if first is None or first + period_s > until:
                first = oldest if first is None else min(first, oldest)
            until = max(newest - late_s, until if until is not None else newest - late_s)
        if alarms:
            _alarm_step(spark, target, number, alarms, keys, period_s, until, first)
        # The clock is written last: it says that the batch is whole.
        spark.createDataFrame([(until, first)], _CLOCK).coalesce(1).write.mode(
            "overwrite").parquet(f"{target}/clock/batch={number}")

    return (events.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or _NOW)).start())


def _alarm_step(spark, target, number, alarms, keys, period_s, until, first) -> None:
    """Moves each alarm on to the last of its periods that is closed. Periods of an alarm that
    span several of the stream wait in ``pending`` until they are whole."""
    closed = spark.read.parquet(f"{target}/periods/batch={number}")
    closed = closed.where(F.col("period") + period_s <= until) if until is not None \
        else closed.limit(0)
    waiting = _read(spark, f"{target}/pending/batch={number - 1}")
    carry = _read(spark, f"{target}/alarms/batch={number - 1}")
    parts = [closed.where((F.col(keys[0]) == a.metric) & _matches(a.dimensions)).select(
        F.lit(a.name).alias("alarm"), F.lit(a.statistic).alias("statistic"),
        F.lit(a.period_s).alias("period_s"),
        (F.floor(F.col("period") / a.period_s) * a.period_s).alias("period"),
        "total", "low", "high", "valued") for a in alarms]
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    if waiting is not None:
        rows = rows.unionByName(waiting)
    merged = rows.groupBy("alarm", "statistic", "period_s", "period").agg(
        F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("valued").alias("valued"))
    merged.write.mode("overwrite").parquet(f"{target}/pending-all/batch={number}")
    merged = spark.read.parquet(f"{target}/pending-all/batch={number}")
    whole = F.col("period") + F.col("period_s") <= F.lit(until)
    merged.where(F.coalesce(~whole, F.lit(True))).write.mode("overwrite").parquet(
        f"{target}/pending/batch={number}")
    measured = merged.where(whole).select(
        "alarm", "period", "statistic", F.col("total").alias("s"),
        F.try_divide("total", "valued").alias("a"), F.col("low").alias("lo"),
        F.col("high").alias("hi"), F.col("valued").cast("double").alias("n")) \
        .select("alarm", "period", metrics.statistic().alias("statistic_value"))
    changes, carried = [], []
    for length in sorted({a.period_s for a in alarms}):
        mine = [a for a in alarms if a.period_s == length]
        start = 0 if first is None else first
        end = start if until is None else max(start // length * length, until // length * length)
        c, s = metrics.alarm_changes(measured, mine, start, end, carry)
        changes.append(c)
        # An alarm that has seen no period yet has no state to go on from.
        carried.append(s.where(F.col("next_period") > F.lit(start // length * length)))
    for frames, name in ((changes, "changes"), (carried, "alarms")):
        out = frames[0]
        for more in frames[1:]:
            out = out.unionByName(more)
        out.write.mode("overwrite").parquet(f"{target}/{name}/batch={number}")


def _matches(dimensions: dict) -> Column:
    out = F.lit(True)
    for name, value in dimensions.items():
        out = out & (F.col(name) == value)
    return out


def closed(spark: SparkSession, target: str, period_s: int = 300) -> DataFrame:
    """Periods that will not change, each from the batch that closed it."""
    clock = F.broadcast(spark.read.parquet(f"{target}/clock").select("batch", "until"))  # a row per batch
    return (spark.read.parquet(f"{target}/periods").join(clock, "batch")
            .where(F.col("period") + period_s <= F.col("until")).drop("until", "batch"))


def kept(spark: SparkSession, target: str, period_s: int = 300) -> DataFrame:
    """All periods so far: closed ones, and those open after the last whole batch."""
    last = spark.read.parquet(f"{target}/clock").agg(F.max("batch")).first()[0]
    until, _ = _clock(spark, target, last)
    still = spark.read.parquet(f"{target}/periods/batch={last}")
    if until is not None:
        still = still.where(F.col("period") + period_s > until)
    return closed(spark, target, period_s).unionByName(still)


def late(spark: SparkSession, target: str) -> DataFrame:
    """Events that came after their period was closed, whole."""
    return spark.read.parquet(f"{target}/late").drop("batch")


def changes(spark: SparkSession, target: str) -> DataFrame:
    """(alarm, period_start, state): where an alarm's state begins or changes."""
    return spark.read.parquet(f"{target}/changes").drop("batch")
