"""Metrics as a long table, alarms over periods, and dashboard series."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fixed_values as fv
from ..session import settle
from .issues import unfold
from .ranking import number_rows

METRIC = ("struct<namespace:string,name:string,value:double,unit:string,ts:timestamp,"
          "dimensions:map<string,string>>")
NAMESPACE = "DataQuality"
VALIDATOR = fv.VALIDATOR_DIMENSION


def _dimensions(values: dict) -> Column:
    pairs = [F.lit(v) if isinstance(v, str) else v for kv in values.items() for v in kv]
    return F.create_map(*pairs)


def metric(name: str, value: Column, unit: str, ts: Column, dimensions: dict,
           namespace: str = NAMESPACE) -> Column:
    return F.struct(
        F.lit(namespace).alias("namespace"), F.lit(name).alias("name"),
        value.cast("double").alias("value"), F.lit(unit).alias("unit"),
        ts.cast("timestamp").alias("ts"), _dimensions(dimensions).alias("dimensions"))


def dq_metrics(scores: DataFrame, ts: Column, namespace: str = NAMESPACE,
               run: dict = fv.RUN_DIMENSION, names: dict | None = None) -> DataFrame:
    """Score, passed, failed and records of each table's score row.

    ``names`` maps table names to the names that alarms and dashboards know them by."""
    shown = F.col("table_name")
    for own, known in (names or {}).items():
        shown = F.when(F.col("table_name") == own, known).otherwise(shown)
    table = {"Dataset": shown}
    return scores.select(F.inline_outer(F.array(
        metric(fv.SCORE_METRIC, F.col("overall_score"), "Percent", ts,
               {**table, **run}, namespace),
        metric(fv.RULES_PASSED_METRIC, F.col("rules_passed"), "Count", ts, table, namespace),
        metric(fv.RULES_FAILED_METRIC, F.col("rules_failed"), "Count", ts, table, namespace),
        metric(fv.RECORDS_METRIC, F.col("total_records"), "Count", ts, table, namespace))))


def tally(validated: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts of statuses and issue types and the sum of scores, in one pass.

    Each record gives one entry per status, issue and score, merged within tasks; the
    result has one row (per group) with an array as long as there are issue types.
    """
    v = F.col("_validation")

    def entry(kind, key, amount):
        return F.struct(F.lit(kind).alias("kind"), key.alias("key"),
                        amount.cast("double").alias("amount"))

    entries = F.concat(
        F.array(entry("status", v["status"], F.lit(1)),
                entry("relevance", F.lit(""), v["relevance_score"])),
        F.transform(v["issues"], lambda i: entry("issue", i["type"], F.lit(1))))
    return (validated.select(*by, unfold(entries)).groupBy(*by, "kind", "key")
            .agg(F.count("amount").alias("n"), F.sum("amount").alias("amount"))
            .groupBy(*by).agg(F.collect_list(F.struct("kind", "key", "n", "amount")).alias("t")))


def validation_metrics(tallied: DataFrame, ts: Column, namespace: str = NAMESPACE,
                       dimensions: dict | None = None) -> DataFrame:
    """Base metrics, one metric per issue type and the gate metrics of a tally."""
    t = F.col("t")
    own = dimensions or VALIDATOR

    def count(kind, key=None):
        chosen = F.filter(t, lambda e: (e["kind"] == kind) if key is None
                          else (e["kind"] == kind) & (e["key"] == key))
        return F.aggregate(chosen, F.lit(0).cast("long"), lambda a, e: a + e["n"])

    def amount(kind):
        return F.aggregate(F.filter(t, lambda e: e["kind"] == kind), F.lit(0.0),
                           lambda a, e: a + F.coalesce(e["amount"], F.lit(0.0)))

    rate = F.round(count("status", "PASS") / F.greatest(count("status"), F.lit(1)) * 100, 1)
    scored = count("relevance")
    relevance = F.coalesce(F.round(F.try_divide(amount("relevance"), scored), 1), F.lit(0.0))
    base = [
        metric(fv.PASS_RATE_METRIC, rate, "Percent", ts, own, namespace),
        metric(fv.ERRORS_METRIC, count("status", "FAIL"), "Count", ts, own, namespace),
        metric(fv.WARNINGS_METRIC, count("status", "WARNING"), "Count", ts, own, namespace),
        metric(fv.QUALITY_METRIC, rate, "Percent", ts, own, namespace)]
    gates = [
        metric(fv.PROFANITY_METRIC, count("issue", "RA_PROFANITY"), "Count", ts, own,
               namespace),
        metric(fv.PHI_METRIC, count("issue", "RA_PHI_EXPOSURE"), "Count", ts, own,
               namespace),
        metric(fv.RELEVANCE_METRIC, relevance, "Percent", ts, own, namespace)]
    by_type = F.transform(
        F.filter(t, lambda e: e["kind"] == "issue"),
        lambda e: metric(fv.BY_TYPE_METRIC, e["n"], "Count", ts,
                         {"ErrorType": e["key"], **own}, namespace))
    parts = [F.array(*base).cast(f"array<{METRIC}>"), by_type.cast(f"array<{METRIC}>"),
             F.when(scored > 0, F.array(*gates).cast(f"array<{METRIC}>"))
             .otherwise(F.array().cast(f"array<{METRIC}>"))]
    return tallied.select(F.inline_outer(F.concat(*parts)))


def batches(metrics: DataFrame, size: int = fv.METRIC_BATCH) -> DataFrame:
    """Metrics with the ``batch_id`` of the group of ``size`` they are sent in."""
    keyed = metrics.withColumn("_dims", F.to_json("dimensions"))
    numbered = number_rows(keyed, [], ["namespace", "ts", "name", "_dims"])
    return (numbered.withColumn("batch_id", F.floor((F.col("position") - 1) / size))
            .drop("_dims", "position"))


# --- alarms ----------------------------------------------------------------------------

@dataclass(frozen=True)
class Alarm:
    """``strict`` asks for exactly the alarm's dimensions, else they may be a part of the
    metric's. ``missing`` is breaching or notBreaching. ``statistic`` is Average, Sum,
    Minimum, Maximum or SampleCount; ``compare`` is <, <=, > or >=."""

    name: str
    metric: str
    dimensions: dict = field(default_factory=dict)
    statistic: str = "Average"
    compare: str = "<"
    threshold: float = 0.0
    periods: int = 1
    period_s: int = fv.PERIOD_SECONDS
    missing: str = "notBreaching"
    strict: bool = False

    def __post_init__(self):
        if self.statistic not in _STATISTICS or self.compare not in ("<", "<=", ">", ">="):
            raise ValueError(f"{self.name}: {self.statistic} {self.compare}")
        if self.missing not in ("breaching", "notBreaching"):
            raise ValueError(f"{self.name}: missing {self.missing}")
        if self.periods < 1 or self.period_s < 1:
            raise ValueError(f"{self.name}: periods and their length are at least 1")


_STATISTICS = {"Average": "a", "Sum": "s", "Minimum": "lo", "Maximum": "hi", "SampleCount": "n"}


DEFAULT_ALARMS = [Alarm(*row[:7], missing=row[7]) for row in fv.ALARMS]

_ALARM_SCHEMA = ("alarm string, metric string, want map<string,string>, statistic string, "
                 "compare string, threshold double, periods int, period_s int, missing string, "
                 "strict boolean")


def _alarm_table(spark, alarms: Sequence[Alarm]) -> DataFrame:
    rows = [(a.name, a.metric, a.dimensions, a.statistic, a.compare, a.threshold, a.periods,
             a.period_s, a.missing, a.strict) for a in alarms]
    return F.broadcast(spark.createDataFrame(rows, _ALARM_SCHEMA))


def alarm_states(metrics: DataFrame, alarms: Sequence[Alarm], start=None, end=None) -> DataFrame:
    """(alarm, period_start, statistic_value, breaching, state) for every period.

    A period without data counts as the alarm's ``missing`` says. ``start`` and ``end``
    (epoch seconds) bound the periods looked at; the default is the span of the data.
    """
    spark = metrics.sparkSession
    table = _alarm_table(spark, alarms)
    measured = measure_alarms(metrics, alarms).withColumnsRenamed({"alarm": "_a", "period": "_p"})
    # Written once: its span bounds the periods, and the states read it again.
    measured = settle(measured, "measured")
    if start is None or end is None:
        span = measured.agg(F.min("_p"), F.max("_p")).first()
        start, end = (span[0] if start is None else start), (span[1] if end is None else end)
    spine = None
    for a in alarms:  # a range per alarm is made by many tasks, whatever the span
        first = 0 if start is None else start // a.period_s * a.period_s
        last = 0 if start is None or end is None else end + 1
        periods = spark.range(first, max(first, last), a.period_s).select(
            F.lit(a.name).alias("_alarm"), F.col("id").alias("period"))
        spine = periods if spine is None else spine.unionByName(periods)
    spine = spine.join(table, F.col("_alarm") == F.col("alarm")).drop("_alarm")
    value, limit = F.col("statistic_value"), F.col("threshold")
    breach = (F.when(value.isNull(), F.col("missing") == "breaching")
              .when(F.col("compare") == "<", value < limit)
              .when(F.col("compare") == "<=", value <= limit)
              .when(F.col("compare") == ">", value > limit).otherwise(value >= limit))
    # One task orders an alarm's periods: a row per period, some 100,000 a year at 300 s.
    by_period = Window.partitionBy("alarm").orderBy("period")
    calm = F.max(F.when(~F.col("breaching"), F.col("n"))).over(
        by_period.rowsBetween(Window.unboundedPreceding, 0))
    return (spine.join(measured, (F.col("alarm") == F.col("_a")) & (F.col("period") == F.col("_p")),
                       "left")
            .withColumn("breaching", breach).withColumn("n", F.row_number().over(by_period))
            .withColumn("streak", F.col("n") - F.coalesce(calm, F.lit(0)))
            .select("alarm", F.timestamp_seconds("period").alias("period_start"),
                    "statistic_value", "breaching",
                    F.when(F.col("streak") >= F.col("periods"), "ALARM").otherwise("OK")
                    .alias("state")))


_CARRY = "alarm string, next_period bigint, streak bigint, state string"


def alarm_changes(measured: DataFrame, alarms: Sequence[Alarm], start: int, end: int,
                  carry: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(changes, carry) of alarms over the periods from ``start`` to before ``end`` (epoch
    seconds): a row (alarm, period_start, state) where a state begins or changes, and a row
    per alarm (alarm, next_period, streak, state) to go on from.

    ``measured`` (alarm, period, statistic_value) has a row per alarm and period with data.
    Periods without any are never made: a run of them is one interval between two rows, so a
    single reading far ahead costs one row. Runs of equal verdicts are merged into islands; an
    alarm goes off within an island once its breaching periods are enough. With the ``carry`` of
    an earlier call its alarms go on where they stopped, and only changes are returned.
    """
    spark = measured.sparkSession
    table = _alarm_table(spark, alarms)
    value, limit = F.col("statistic_value"), F.col("threshold")
    verdict = (F.when(value.isNull(), F.col("missing") == "breaching")
               .when(F.col("compare") == "<", value < limit)
               .when(F.col("compare") == "<=", value <= limit)
               .when(F.col("compare") == ">", value > limit).otherwise(value >= limit))
    before = carry if carry is not None else spark.createDataFrame([], _CARRY)
    step = F.col("period_s").cast("bigint")
    opened = table.join(F.broadcast(before.withColumnRenamed("alarm", "_b")),
                        F.col("alarm") == F.col("_b"), "left").drop("_b").select(
        "alarm", "compare", "threshold", "missing", "periods", step.alias("period_s"),
        F.coalesce("next_period", F.floor(F.lit(start) / step) * step).alias("first"),
        (F.ceil(F.lit(end) / step) * step).alias("stop"),
        F.coalesce("streak", F.lit(0)).alias("streak"), F.col("state").alias("was"))
    rows = opened.join(measured.withColumnRenamed("alarm", "_m"),
                       (F.col("alarm") == F.col("_m")) & (F.col("period") >= F.col("first"))
                       & (F.col("period") < F.col("stop")), "left").drop("_m")
    by_period = Window.partitionBy("alarm").orderBy("period")
    after = F.coalesce(F.lead("period").over(by_period), F.col("stop"))
    gap = F.col("missing") == "breaching"

    def run(begin: Column, until: Column, breaching: Column) -> Column:
        return F.struct(begin.alias("begin"), F.floor((until - begin) / F.col("period_s"))
                        .cast("bigint").alias("length"), breaching.alias("breaching"))

    place, next_ = F.col("period"), F.col("period") + F.col("period_s")
    runs = F.when(place.isNull(), F.array(run(F.col("first"), F.col("stop"), gap))).otherwise(
        F.array(F.when(F.lag("period").over(by_period).isNull(),
                       run(F.col("first"), place, gap)),
                run(place, next_, verdict), run(next_, after, gap)))
    state = ["alarm", "periods", "period_s", "stop", "streak", "was"]
    found = rows.select(*state, runs.alias("runs")).select(*state, F.explode("runs").alias("r")) \
        .where("r IS NOT NULL AND r.length > 0").select(*state, "r.*")
    by_begin = Window.partitionBy("alarm").orderBy("begin")
    fresh = F.coalesce(F.lag("breaching").over(by_begin) != F.col("breaching"), F.lit(True))
    islands = (found.withColumn("fresh", fresh)
               .withColumn("island", F.sum(F.col("fresh").cast("int")).over(by_begin))
               .groupBy(*state, "island", "breaching")
               .agg(F.min("begin").alias("begin"), F.sum("length").alias("length")))
    # The breaching periods before the first island belong to it if it breaches as well.
    had = F.when(F.col("breaching") & (F.col("island") == 1), F.col("streak")).otherwise(0)
    wait = F.greatest(F.lit(0), F.col("periods") - had - 1)
    by_island = Window.partitionBy("alarm").orderBy("island")
    fires = F.col("breaching") & (F.col("length") > wait)
    marks = F.array(
        # An alarm that is new starts with a state; it is OK until it has fired.
        F.when((F.col("island") == 1) & F.col("was").isNull()
               & ~(fires & (wait == 0)), F.struct(F.col("begin").alias("p"), F.lit("OK").alias("s"))),
        F.when(~F.col("breaching"), F.struct(F.col("begin").alias("p"), F.lit("OK").alias("s"))),
        F.when(fires, F.struct((F.col("begin") + wait * F.col("period_s")).alias("p"),
                               F.lit("ALARM").alias("s"))))
    told = islands.select("alarm", "was", "island", F.explode(marks).alias("m")) \
        .where("m IS NOT NULL").select("alarm", "was", "island", "m.*").distinct()
    in_order = Window.partitionBy("alarm").orderBy("p", "island")
    changes = (told.withColumn("last", F.coalesce(F.lag("s").over(in_order), F.col("was")))
               .where("last IS NULL OR last != s")
               .select("alarm", F.timestamp_seconds("p").alias("period_start"),
                       F.col("s").alias("state")))
    last = (islands.withColumn("total", F.when(F.col("breaching"), F.col("length") + had)
                               .otherwise(0))
            .groupBy("alarm").agg(F.max_by("total", "island").alias("total"),
                                  F.max("periods").alias("periods")))
    kept = opened.join(last.select(F.col("alarm").alias("_l"), "total"),
                       F.col("alarm") == F.col("_l"), "left").select(
        "alarm", F.greatest("first", "stop").alias("next_period"),
        F.coalesce("total", "streak").cast("bigint").alias("streak"))
    kept = kept.join(table.select(F.col("alarm").alias("_t"), "periods"),
                     F.col("alarm") == F.col("_t")).select(
        "alarm", "next_period", "streak",
        F.when(F.col("streak") >= F.col("periods"), "ALARM").otherwise("OK").alias("state"))
    return changes, kept


def measure_alarms(metrics: DataFrame, alarms: Sequence[Alarm]) -> DataFrame:
    """(alarm, period, statistic_value) per alarm and period with data."""
    table = _alarm_table(metrics.sparkSession, alarms)
    subset = F.forall(F.map_entries("want"),
                      lambda e: F.coalesce(F.element_at("dimensions", e["key"]) == e["value"],
                                           F.lit(False)))
    exact = ~F.col("strict") | (F.size("want") == F.size("dimensions"))
    period = F.floor(F.unix_seconds("ts") / F.col("period_s")) * F.col("period_s")
    return (metrics.join(table, (F.col("name") == F.col("metric")) & subset & exact)
            .groupBy("alarm", "statistic", period.alias("period"))
            .agg(F.sum("value").alias("s"), F.avg("value").alias("a"),
                 F.min("value").alias("lo"), F.max("value").alias("hi"),
                 F.count("value").cast("double").alias("n"))
            .select("alarm", "period", statistic().alias("statistic_value")))


def statistic() -> Column:
    """The value of column ``statistic`` from s, a, lo, hi and n."""
    return F.expr("CASE statistic " + " ".join(
        f"WHEN '{k}' THEN {c}" for k, c in _STATISTICS.items()) + " END")


# --- series ----------------------------------------------------------------------------

def _period(period_s: int) -> Column:
    return F.window("ts", f"{period_s} seconds")


def series(metrics: DataFrame, names: Sequence[str], statistic: str = "Average",
           period_s: int = fv.PERIOD_SECONDS, dimensions: dict | None = None) -> DataFrame:
    """(name, period_start, value): a statistic per tumbling period for each metric."""
    chosen = metrics.where(F.col("name").isin(list(names)))
    for key, value in (dimensions or {}).items():
        chosen = chosen.where(F.element_at("dimensions", key) == value)
    measure = {"Average": F.avg, "Sum": F.sum}[statistic]("value")
    return (chosen.groupBy("name", _period(period_s).alias("w")).agg(measure.alias("value"))
            .select("name", F.col("w.start").alias("period_start"), "value"))


def score_series(metrics: DataFrame, **kw) -> DataFrame:
    return series(metrics, [fv.SCORE_METRIC], "Average", **kw)


def pass_rate_series(metrics: DataFrame, **kw) -> DataFrame:
    return series(metrics, [fv.PASS_RATE_METRIC], "Average", **kw)


def rules_series(metrics: DataFrame, **kw) -> DataFrame:
    return series(metrics, [fv.RULES_PASSED_METRIC, fv.RULES_FAILED_METRIC], "Sum", **kw)


def errors_series(metrics: DataFrame, **kw) -> DataFrame:
    return series(metrics, [fv.ERRORS_METRIC, fv.WARNINGS_METRIC], "Sum", **kw)


def records_series(metrics: DataFrame, **kw) -> DataFrame:
    return series(metrics, [fv.RECORDS_METRIC], "Sum", **kw)


def type_series(metrics: DataFrame, types: Sequence[str] = tuple(fv.SERIES_ISSUE_TYPES),
                period_s: int = fv.PERIOD_SECONDS) -> DataFrame:
    """Issues per period, one column per issue type (0 where a period had none of it)."""
    kind = F.element_at("dimensions", "ErrorType")
    return (metrics.where((F.col("name") == fv.BY_TYPE_METRIC) & kind.isin(list(types)))
            .groupBy(_period(period_s).alias("w"))
            .agg(*[F.coalesce(F.sum(F.when(kind == t, F.col("value"))), F.lit(0.0)).alias(t)
                   for t in types])
            .select(F.col("w.start").alias("period_start"), *types))
