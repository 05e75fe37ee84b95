"""Queries: streams over the driver files, run to their end and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rules as r
from ..operators.analyzers import Analyzer
from ..operators.metrics import Alarm
from ..session import fresh_path
from ..streaming import periods as pr, streams as st
from . import derived
from .derived import AS_OF, with_ctes
from .registry import query, table
from .validation_queries import FULL, status_sql


def _stream(spark, sf_dir, name):
    return st.read_files(spark, f"{sf_dir}/{name}.parquet*", table(spark, sf_dir, name).schema)


def _paths(spark, name):
    return fresh_path(spark, name), fresh_path(spark, f"{name}-progress")


@query("stream_validate", with_ctes("rec", status_sql(FULL)))
def _(spark, sf_dir):
    target, progress = _paths(spark, "stream-validated")
    records = derived.records_of(_stream(spark, sf_dir, "orders"))
    st.once(st.validate_stream(records, target, progress, "full", AS_OF))
    v = "_validation"
    return spark.read.parquet(target).select(
        "record_id", f"{v}.error_count", f"{v}.warning_count", f"{v}.status")


@query("stream_gate", """
WITH p AS (SELECT *, o_orderkey % 6 AS part FROM orders), b AS (
  SELECT part, avg(o_totalprice) + CASE WHEN part = 5 THEN 1000000 ELSE 0 END AS mean,
    count(*) FILTER (o_totalprice > 490000) > 0 AND part IN (1, 2) AS broken FROM p GROUP BY part)
SELECT CASE WHEN broken OR part = 5 THEN 'quarantine' ELSE 'pass' END AS decision,
  CAST(sum((SELECT count(*) FROM p WHERE p.part = b.part)) AS BIGINT) AS orders
FROM b GROUP BY ALL""")
def _(spark, sf_dir):
    """Six arrivals, one batch each: prices above the range break a rule of the second and
    third, and the last one's mean is out of line with the five before it."""
    source, target = _paths(spark, "stream-gated")
    progress, history = _paths(spark, "stream-history")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    price = F.col("o_totalprice")
    for part in range(6):
        mine = orders.where(F.col("o_orderkey") % 6 == part)
        mine.withColumn("o_totalprice", price + 1e6 if part == 5 else price).withColumn(
            "most", F.lit(490000.0 if part in (1, 2) else 1e9)).write.parquet(f"{source}/{part}")
        arrivals = st.read_files(spark, f"{source}/*", "o_orderkey bigint, o_totalprice double, "
                                                       "most double")
        st.once(st.gate_stream(
            arrivals, [r.where_count("o_totalprice > most"), r.unique("o_orderkey"),
                       r.row_count(least=1)], "orders", target, progress,
            watched=[Analyzer("mean", "o_totalprice")], history=history, width=8.0))
    return st.gated(spark, target).groupBy("decision").agg(F.count("*").alias("orders"))


def _events(spark, sf_dir):
    return _stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _ordered_parts(spark, sf_dir, name, parts=3):
    """The events in time order, in as many folders, so that each makes a batch of its own."""
    source = fresh_path(spark, name)
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    low, high = events.agg(F.unix_seconds(F.min("ts")), F.unix_seconds(F.max("ts"))).first()
    part = F.least(F.lit(parts - 1), F.floor(
        (F.unix_seconds("ts") - low) * parts / max(1, high - low)).cast("int"))
    for i in range(parts):
        events.where(part == i).write.parquet(f"{source}/{i}")
        yield st.read_files(spark, f"{source}/*", events.schema)


def _event_periods(spark, sf_dir):
    target, progress = _paths(spark, "stream-periods")
    for arrivals in _ordered_parts(spark, sf_dir, "stream-ordered"):
        st.once(st.period_stream(arrivals, target, progress, F.col("value"), "10 minutes",
                                 ["event_type"]))
    return target


@query("stream_alarm_periods", """
SELECT strftime(time_bucket(INTERVAL 300 SECOND, ts), '%Y-%m-%d %H:%M:%S') AS period_start,
  event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def _(spark, sf_dir):
    merged = fresh_path(spark, "stream-merged")
    st.compact(spark, _event_periods(spark, sf_dir), merged, ["period_start", "event_type"])
    return st.current(spark, merged, ["period_start", "event_type"]).select(
        F.date_format("period_start", "yyyy-MM-dd HH:mm:ss").alias("period_start"), "event_type",
        "n", F.round("total", 4).alias("total"))


_STREAM_ALARMS = [Alarm("errors", "error", {}, "Sum", ">", 60.0, 1, 300),
                  Alarm("quiet", "purchase", {}, "Sum", "<", 10.0, 3, 300, "breaching")]


def _stream_alarm_sql(a):
    missing = "true" if a.missing == "breaching" else "false"
    return f"""SELECT '{a.name}' AS alarm, p, b, CASE WHEN count(*) OVER w = {a.periods}
      AND bool_and(b) OVER w THEN 'ALARM' ELSE 'OK' END AS state FROM (SELECT p,
        CASE WHEN v IS NULL THEN {missing} ELSE v {a.compare} {a.threshold} END AS b
      FROM (SELECT unnest(generate_series(lo, hi, 300)) AS p FROM bounds) LEFT JOIN
        (SELECT p, sum(value) AS v FROM e WHERE event_type = '{a.metric}' GROUP BY p) USING (p))
    WINDOW w AS (ORDER BY p ROWS BETWEEN {a.periods - 1} PRECEDING AND CURRENT ROW)"""


@query("stream_alarm_states", "WITH e AS (SELECT *, (epoch_us(ts) // 300000000) * 300 AS p "
       "FROM events), bounds AS (SELECT min(p) AS lo, max(p) AS hi FROM e WHERE event_type IN "
       "('error', 'purchase')) SELECT alarm, strftime(make_timestamp(p * 1000000), "
       "'%Y-%m-%d %H:%M:%S') AS period_start, b AS breaching, state FROM ("
       + " UNION ALL ".join(map(_stream_alarm_sql, _STREAM_ALARMS)) + ")")
def _(spark, sf_dir):
    states = st.alarm_stream_states(spark, _event_periods(spark, sf_dir), _STREAM_ALARMS,
                                    "event_type")
    return states.select("alarm", F.date_format("period_start", "yyyy-MM-dd HH:mm:ss")
                         .alias("period_start"), "breaching", "state")


@query("stream_dedup", """
SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
  arg_max(value, event_id) AS value FROM events GROUP BY user_id""")
def _(spark, sf_dir):
    target, progress = _paths(spark, "stream-last")
    for arrivals in _ordered_parts(spark, sf_dir, "stream-updates"):
        rows = arrivals.select("user_id", "event_id", "event_type", "value")
        st.once(st.last_wins_stream(rows, "user_id", "event_id", target, progress))
    return st.current(spark, target, ["user_id"], "event_id")


@query("stream_dedup_first", """
SELECT user_id, event_type, min(date_diff('day', d, ts::DATE) // 10) AS arrival FROM events,
  (SELECT min(ts)::DATE AS d FROM events) GROUP BY user_id, event_type""")
def _(spark, sf_dir):
    """Ten days arrive at a time, and a key's row has to be of the first arrival that has it.
    The delay spans the whole table, whose keys all stay in state."""
    target, progress = _paths(spark, "stream-first")
    low, high = table(spark, sf_dir, "events").agg(
        F.min(F.col("ts").cast("date")), F.max(F.col("ts").cast("date"))).first()
    for day in range((high - low).days + 1) if low is not None else ():
        if day % 10:
            continue
        ten = (F.col("ts") >= F.lit(low) + F.expr(f"INTERVAL {day} DAYS")) & (
            F.col("ts") < F.lit(low) + F.expr(f"INTERVAL {day + 10} DAYS"))
        table(spark, sf_dir, "events").where(ten).withColumn(
            "ts", F.col("ts").cast("timestamp")).withColumn(
            "arrival", F.lit(day // 10).cast("long")).write.parquet(f"{target}-in/{day}")
        arrivals = st.read_files(spark, f"{target}-in/*", spark.read.parquet(
            f"{target}-in/{day}").schema)
        first = st.first_wins(arrivals, ["user_id", "event_type"], "ts",
                              f"{(high - low).days + 1} days")
        st.once(first.writeStream.format("parquet").option("path", target)
                .option("checkpointLocation", progress).trigger(availableNow=True).start())
    return spark.read.parquet(target).select("user_id", "event_type", "arrival")


@query("stream_late_policy", """
SELECT count(*) AS periods, CAST(sum(n) AS BIGINT) AS kept_events FROM (
  SELECT count(*) AS n FROM events, (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS middle FROM events)
  WHERE ts >= middle GROUP BY time_bucket(INTERVAL 300 SECOND, ts))""")
def _(spark, sf_dir):
    """Events arrive newest half first. Once the watermark has passed them, the events of the
    older half are dropped. How many groups that makes depends on tasks, so it isn't shown."""
    source, target = _paths(spark, "stream-late")
    progress = fresh_path(spark, "stream-late-progress")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    span = events.agg((F.min("ts") + (F.max("ts") - F.min("ts")) / 2).alias("middle"))
    tagged = events.crossJoin(F.broadcast(span))  # one row
    for i, half in enumerate(("ts >= middle", "ts < middle")):
        tagged.where(half).drop("middle").write.parquet(f"{source}/{i}")
        st.once(st.period_stream(st.read_files(spark, f"{source}/*", events.schema), target,
                                 progress, F.col("value"), "10 minutes"))
    return st.current(spark, target, ["period_start"]).agg(
        F.count("*").alias("periods"), F.sum("n").alias("kept_events"))


@query("stream_late_rows", """
WITH m AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS middle FROM events)
SELECT event_type, CAST(count(*) FILTER (ts >= middle) AS BIGINT) AS kept,
  CAST(count(*) FILTER (ts < middle) AS BIGINT) AS late,
  CAST(coalesce(sum(event_id) FILTER (ts < middle), 0) AS BIGINT) AS late_ids
FROM events, m GROUP BY event_type""")
def _(spark, sf_dir):
    """The newest half arrives first; every event of the older half is then late, and kept as
    it came: periods and late events add up to all events."""
    source, target = _paths(spark, "stream-late-rows")
    progress = fresh_path(spark, "stream-late-rows-progress")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    row = events.agg((F.min("ts") + (F.max("ts") - F.min("ts")) / 2).alias("middle")).first()
    for i, half in enumerate((F.col("ts") >= F.lit(row["middle"]), F.col("ts") < F.lit(row["middle"]))):
        events.where(half).write.parquet(f"{source}/{i}")
        st.once(pr.period_stream(st.read_files(spark, f"{source}/*", events.schema), target,
                                 progress, F.col("value"), 600, ["event_type"]))
    kept = pr.kept(spark, target).groupBy("event_type").agg(F.sum("n").alias("kept"))
    late = pr.late(spark, target).groupBy(F.col("event_type").alias("t")).agg(
        F.count("*").alias("late"), F.sum("event_id").alias("late_ids"))
    zero = F.lit(0).cast("long")
    return kept.join(late, F.expr("event_type = t"), "full").select(
        F.coalesce("event_type", "t").alias("event_type"), F.coalesce("kept", zero).alias("kept"),
        F.coalesce("late", zero).alias("late"), F.coalesce("late_ids", zero).alias("late_ids"))


def _changes_sql(states: str) -> str:
    """Rows of states per period where an alarm's state begins or changes."""
    return f"""SELECT alarm, strftime(make_timestamp(p * 1000000), '%Y-%m-%d %H:%M:%S')
      AS period_start, state FROM (SELECT *, lag(state) OVER (PARTITION BY alarm ORDER BY p) AS was
    FROM ({states})) WHERE was IS NULL OR was <> state"""


@query("stream_alarm_changes", "WITH e AS (SELECT *, (epoch_us(ts) // 300000000) * 300 AS p "
       "FROM events), bounds AS (SELECT min(p) AS lo, max(p) AS hi FROM e) "
       + _changes_sql(" UNION ALL ".join(map(_stream_alarm_sql, _STREAM_ALARMS))))
def _(spark, sf_dir):
    """Alarms from the stream itself. A beat ten minutes after the last period, of a kind that no
    alarm reads, closes all periods; nothing is made for those without events."""
    source, target = _paths(spark, "stream-alarms")
    progress = fresh_path(spark, "stream-alarms-progress")
    late = 600

    def run(arrivals):
        st.once(pr.period_stream(arrivals, target, progress, F.col("value"), late,
                                 ["event_type"], alarms=_STREAM_ALARMS))

    columns = ["ts", "event_type", "value"]
    events = table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    low, high = events.agg(F.unix_seconds(F.min("ts")), F.unix_seconds(F.max("ts"))).first()
    third = F.least(F.lit(2), F.floor((F.unix_seconds("ts") - low) * 3 / max(1, high - low)))
    beat = spark.range(1).select(
        F.timestamp_seconds(F.lit(high // 300 * 300 + 300 + late)).alias("ts"),
        F.lit("beat").alias("event_type"), F.lit(None).cast("double").alias("value"))
    for i in range(4):
        (events.where(third == i) if i < 3 else beat).select(*columns).write.parquet(
            f"{source}/{i}")
        run(st.read_files(spark, f"{source}/*", events.schema))
    return pr.changes(spark, target).select(
        "alarm", F.date_format("period_start", "yyyy-MM-dd HH:mm:ss").alias("period_start"), "state")
