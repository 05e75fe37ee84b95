"""Queries: metrics, alarms and dashboard series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..operators import metrics as m, rules as r
from ..session import settle
from . import derived
from .registry import query, table
from .rule_queries import SCORES_SQL, _results, over_results
from .text_queries import SCORE_SQL, full_frame, full_sql

TS = "2024-01-01 00:00:00"
DAY = 86400


def shown(df):
    """Metrics with time and dimensions as text."""
    dims = F.array_join(F.array_sort(F.transform(
        F.map_entries("dimensions"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")
    return df.select("namespace", "name", F.round("value", 4).alias("value"), "unit",
                     F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
                     dims.alias("dimensions"))


def _now():
    return F.lit(TS).cast("timestamp")


def metric_row(name, value, unit, dims, source):
    return (f"SELECT 'DataQuality' AS namespace, '{name}' AS name, "
            f"round(CAST({value} AS DOUBLE), 4) AS value, '{unit}' AS unit, '{TS}' AS ts, "
            f"{dims} AS dimensions FROM {source}")


_OWN = "'Validator=clinical-validator'"
_RATE = ("round(count(*) FILTER (status = 'PASS') * 100.0::DOUBLE / greatest(count(*), 1), 1)")


def _status_count(status):
    return f"count(*) FILTER (status = '{status}')"


def _issue_count(kind):
    return f"count(*) FILTER (type = '{kind}')"


VALIDATION_METRICS = " UNION ALL ".join([
    metric_row("Validation_PassRate", _RATE, "Percent", _OWN, "st"),
    metric_row("Validation_ErrorCount", _status_count("FAIL"), "Count", _OWN, "st"),
    metric_row("Validation_WarningCount", _status_count("WARNING"), "Count", _OWN, "st"),
    metric_row("Validation_QualityScore", _RATE, "Percent", _OWN, "st"),
    metric_row("Validation_ErrorsByType", "n", "Count",
               f"'ErrorType=' || type || ',' || {_OWN}",
               "(SELECT type, count(*) AS n FROM iss GROUP BY type)"),
    metric_row("Validation_ProfanityDetected", _issue_count("RA_PROFANITY"), "Count", _OWN, "iss"),
    metric_row("Validation_PHIExposureRisk", _issue_count("RA_PHI_EXPOSURE"), "Count", _OWN,
               "iss"),
    metric_row("Validation_ClinicalRelevanceScore", f"round(avg({SCORE_SQL}), 1)", "Percent",
               _OWN, "sig")])
_TABLE = "'Dataset=' || table_name"
DQ_METRICS = " UNION ALL ".join([
    metric_row("GlueDQ_OverallScore", "overall_score", "Percent",
               f"{_TABLE} || ',Pipeline=healthcare-ingest'", "sc"),
    metric_row("GlueDQ_RulesPassed", "rules_passed", "Count", _TABLE, "sc"),
    metric_row("GlueDQ_RulesFailed", "rules_failed", "Count", _TABLE, "sc"),
    metric_row("GlueDQ_TotalRecords", "total_records", "Count", _TABLE, "sc")])


@query("metrics_validation", full_sql(VALIDATION_METRICS))
def _(spark, sf_dir):
    return shown(m.validation_metrics(m.tally(full_frame(spark, sf_dir, detail=False)), _now()))


@query("metrics_dq", over_results(DQ_METRICS, sc=SCORES_SQL))
def _(spark, sf_dir):
    return shown(m.dq_metrics(r.score(_results(spark, sf_dir)), _now()))


def _both(spark, sf_dir, names=None):
    # Records and notes are derived once; the rule sets and the checks read what was written.
    frames = (settle(derived.records(spark, sf_dir), "records"),
              settle(derived.notes(spark, sf_dir), "notes"))
    dq = m.dq_metrics(r.score(_results(spark, sf_dir, frames=frames)), _now(), names=names)
    checked = full_frame(spark, sf_dir, frames, detail=False)
    return dq.unionByName(m.validation_metrics(m.tally(checked), _now()))


@query("metrics_pipeline", over_results(DQ_METRICS, sc=SCORES_SQL) + " UNION ALL SELECT * FROM ("
       + full_sql(VALIDATION_METRICS) + ")")
def _(spark, sf_dir):
    return shown(_both(spark, sf_dir))


@query("union_metrics", "SELECT name, unit, count(*) AS n FROM (" + over_results(
    DQ_METRICS, sc=SCORES_SQL) + " UNION ALL SELECT * FROM (" + full_sql(VALIDATION_METRICS)
    + ")) GROUP BY ALL")
def _(spark, sf_dir):
    return _both(spark, sf_dir).groupBy("name", "unit").agg(F.count("*").alias("n"))


# --- metrics of events ------------------------------------------------------------------------
# Each event is a metric reading; an error also counts towards its issue type.

_NAMES = {"error": "Validation_ErrorCount", "signup": "Validation_WarningCount",
          "purchase": "GlueDQ_OverallScore", "view": "Validation_PassRate",
          "click": "GlueDQ_TotalRecords"}
_KINDS = [*fv.SERIES_ISSUE_TYPES, "RA_PROFANITY"]


def event_metrics(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    kind, value = F.col("event_type"), F.col("value")
    name = F.lit(None).cast("string")
    for event, metric_name in _NAMES.items():
        name = F.when(kind == event, metric_name).otherwise(name)
    ts = F.col("ts").cast("timestamp")
    dims = F.create_map(F.lit("Dataset"), F.concat(F.lit("set"), (F.col("user_id") % 3)
                                                   .cast("string")))
    count = F.when(kind == "error", 1.0).otherwise(value)

    def reading(name, value, dims):
        return F.struct(F.lit("DataQuality").alias("namespace"), name.alias("name"),
                        value.alias("value"), F.lit("Count").alias("unit"), ts.alias("ts"),
                        dims.alias("dimensions"))

    of_type = F.create_map(F.lit("ErrorType"), F.element_at(
        F.array(*[F.lit(k) for k in _KINDS]), (F.col("event_id") % 5 + 1).cast("int")))
    both = F.array(reading(name, count, dims),
                   reading(F.lit("Validation_ErrorsByType"), F.lit(1.0), of_type))
    one = F.array(reading(name, count, dims))
    return e.select(F.inline_outer(F.when(kind == "error", both).otherwise(one)))


_CASE = "CASE event_type " + " ".join(f"WHEN '{e}' THEN '{n}'" for e, n in _NAMES.items()) + " END"
_TYPE = f"list_extract({[*_KINDS]}, event_id % 5 + 1)"
EVENT_METRICS = f"""em AS MATERIALIZED (
SELECT {_CASE} AS name, CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE value END AS value, ts,
  'set' || (user_id % 3) AS dataset, NULL AS error_type FROM events
UNION ALL SELECT 'Validation_ErrorsByType', 1.0, ts, NULL, {_TYPE} FROM events
WHERE event_type = 'error')"""


def _text(df, period="period_start"):
    return df.withColumn(period, F.date_format(period, "yyyy-MM-dd HH:mm:ss"))


def _rounded(df):
    return _text(df).withColumn("value", F.round("value", 4))


def bucket(seconds):
    return f"strftime(time_bucket(INTERVAL {seconds} SECOND, ts), '%Y-%m-%d %H:%M:%S')"


def series_sql(names, agg, period=300):
    listed = ", ".join(f"'{n}'" for n in names)
    return (f"WITH {EVENT_METRICS} SELECT name, {bucket(period)} AS period_start, "
            f"round({agg}(value), 4) AS value FROM em WHERE name IN ({listed}) GROUP BY ALL")


_SERIES = {
    "series_score": (m.score_series, ["GlueDQ_OverallScore"], "avg"),
    "series_pass_rate": (m.pass_rate_series, ["Validation_PassRate"], "avg"),
    "series_rules": (m.rules_series, ["GlueDQ_RulesPassed", "GlueDQ_RulesFailed"], "sum"),
    "series_errors": (m.errors_series, ["Validation_ErrorCount", "Validation_WarningCount"], "sum"),
    "series_records": (m.records_series, ["GlueDQ_TotalRecords"], "sum"),
}


def _series(name, fn, names, agg):
    def run(spark, sf_dir):
        return _rounded(fn(event_metrics(spark, sf_dir)))

    query(name, series_sql(names, agg))(run)


for _name, _spec in _SERIES.items():
    if _name != "series_rules":
        _series(_name, *_spec)


@query("series_rules", f"""
WITH x AS (SELECT time_bucket(INTERVAL 300 SECOND, ts) AS p, value > 50 AS good FROM events)
SELECT CASE WHEN good THEN 'GlueDQ_RulesPassed' ELSE 'GlueDQ_RulesFailed' END AS name,
  strftime(p, '%Y-%m-%d %H:%M:%S') AS period_start, count(*)::DOUBLE AS value FROM x GROUP BY ALL""")
def _(spark, sf_dir):
    name = F.when(F.col("value") > 50, "GlueDQ_RulesPassed").otherwise("GlueDQ_RulesFailed")
    readings = table(spark, sf_dir, "events").select(
        name.alias("name"), F.lit(1.0).alias("value"), F.col("ts").cast("timestamp").alias("ts"))
    return _text(m.rules_series(readings))


@query("series_by_type", f"WITH {EVENT_METRICS} SELECT {bucket(300)} AS period_start, " + ", ".join(
    f"coalesce(sum(value) FILTER (error_type = '{t}'), 0.0) AS {t}"
    for t in fv.SERIES_ISSUE_TYPES) + " FROM em WHERE name = 'Validation_ErrorsByType' AND "
    f"error_type IN ({', '.join(repr(t) for t in fv.SERIES_ISSUE_TYPES)}) GROUP BY ALL")
def _(spark, sf_dir):
    return _text(m.type_series(event_metrics(spark, sf_dir)))


ALARMS = [
    m.Alarm("errors", "Validation_ErrorCount", {}, "Sum", ">", 65.0, 1, DAY),
    m.Alarm("errors_twice", "Validation_ErrorCount", {}, "Sum", ">", 60.0, 2, DAY),
    m.Alarm("score", "GlueDQ_OverallScore", {"Dataset": "set1"}, "Average", "<", 50.0, 3, 3600,
            missing="breaching"),
    m.Alarm("interactions", "Validation_ErrorsByType", {"ErrorType": "DRUG_INTERACTION"}, "Sum",
            ">", 1.0, 1, 300),
    m.Alarm("readings", "Validation_PassRate", {}, "SampleCount", "<=", 1.0, 2, 3600),
    m.Alarm("highest", "GlueDQ_TotalRecords", {"Dataset": "set2"}, "Maximum", ">=", 99.0, 1, DAY),
    m.Alarm("strict", "GlueDQ_OverallScore", {}, "Average", "<", 50.0, 1, DAY, "breaching", True),
]


def _chosen(a: m.Alarm):
    if a.strict:
        return "false"
    chosen = f"name = '{a.metric}'"
    if "Dataset" in a.dimensions:
        chosen += f" AND dataset = '{a.dimensions['Dataset']}'"
    if "ErrorType" in a.dimensions:
        chosen += f" AND error_type = '{a.dimensions['ErrorType']}'"
    return chosen


def _alarm_sql(a: m.Alarm):
    chosen = _chosen(a)
    agg = {"Sum": "sum", "Average": "avg", "SampleCount": "count", "Minimum": "min",
           "Maximum": "max"}[a.statistic]
    missing = "true" if a.missing == "breaching" else "false"
    return f"""SELECT '{a.name}' AS alarm, p AS period_start, round(v, 4) AS statistic_value, b AS
  breaching, CASE WHEN count(*) OVER w = {a.periods} AND bool_and(b) OVER w THEN 'ALARM' ELSE 'OK'
  END AS state FROM (SELECT p, v, CASE WHEN v IS NULL THEN {missing} ELSE v {a.compare} {a.threshold}
    END AS b FROM (SELECT unnest(generate_series((lo // {a.period_s}) * {a.period_s}, hi,
      {a.period_s})) AS p FROM bounds) LEFT JOIN (SELECT (epoch_us(ts) // 1000000 // {a.period_s})
      * {a.period_s} AS p, {agg}(value) AS v FROM em WHERE {chosen} GROUP BY ALL) USING (p))
  WINDOW w AS (ORDER BY p ROWS BETWEEN {a.periods - 1} PRECEDING AND CURRENT ROW)"""


def _bounds_sql(alarms):
    """The span of all periods that hold readings of any alarm."""
    periods = " UNION ALL ".join(
        f"SELECT (epoch_us(ts) // 1000000 // {a.period_s}) * {a.period_s} AS p FROM em "
        f"WHERE {_chosen(a)}" for a in alarms)
    return f"bounds AS (SELECT min(p) AS lo, max(p) AS hi FROM ({periods}))"


@query("alarm_eval", f"WITH {EVENT_METRICS}, {_bounds_sql(ALARMS)} SELECT alarm, strftime(make_timestamp(period_start * 1000000), "
       "'%Y-%m-%d %H:%M:%S') AS period_start, statistic_value, breaching, state FROM ("
       + " UNION ALL ".join(_alarm_sql(a) for a in ALARMS) + ")")
def _(spark, sf_dir):
    states = m.alarm_states(event_metrics(spark, sf_dir), ALARMS)
    return _text(states).withColumn("statistic_value", F.round("statistic_value", 4))


@query("alarm_changes", f"WITH {EVENT_METRICS}, {_bounds_sql(ALARMS)} SELECT alarm, "
       "strftime(make_timestamp(period_start * 1000000), '%Y-%m-%d %H:%M:%S') AS period_start, state "
       "FROM (SELECT *, lag(state) OVER (PARTITION BY alarm ORDER BY period_start) AS was FROM ("
       + " UNION ALL ".join(_alarm_sql(a) for a in ALARMS) + ")) WHERE was IS NULL OR was <> state")
def _(spark, sf_dir):
    measured = settle(m.measure_alarms(event_metrics(spark, sf_dir), ALARMS), "measured")
    low, high = measured.agg(F.min("period"), F.max("period")).first()
    if low is None:
        low, high = 0, -1
    changes, _ = m.alarm_changes(measured, ALARMS, low, high + 1)
    return _text(changes)


#: The pipeline's metrics are published now and ten minutes later, under the names that the
#: default alarms ask for; the five minutes between have none.
_RENAMED = {"patient_records_csv": "patient_records"}
_METRICS_SQL = (over_results(DQ_METRICS, sc=SCORES_SQL) + " UNION ALL SELECT * FROM ("
                + full_sql(VALIDATION_METRICS) + ")")
_ALARM_VALUES = {
    "Healthcare-DQ-OverallScore-Low":
        "name = 'GlueDQ_OverallScore' AND dimensions LIKE 'Dataset=patient_records_csv,%'",
    "Healthcare-Validation-HighErrorRate": "name = 'Validation_ErrorCount'",
    "Healthcare-DrugInteraction-Alert":
        "name = 'Validation_ErrorsByType' AND dimensions LIKE 'ErrorType=DRUG_INTERACTION,%'",
}


def _default_sql(a: m.Alarm):
    missing = "true" if a.missing == "breaching" else "false"
    return f"""SELECT '{a.name}' AS alarm, p, v, b, CASE WHEN count(*) OVER w = {a.periods}
      AND bool_and(b) OVER w THEN 'ALARM' ELSE 'OK' END AS state FROM (
      SELECT p, v, CASE WHEN v IS NULL THEN {missing} ELSE v {a.compare} {a.threshold} END AS b
      FROM (SELECT p, CASE WHEN p <> 5 THEN (SELECT sum(value) FROM mt
        WHERE {_ALARM_VALUES[a.name]}) END AS v FROM (VALUES (0), (5), (10)) t(p)))
    WINDOW w AS (ORDER BY p ROWS BETWEEN {a.periods - 1} PRECEDING AND CURRENT ROW)"""


@query("default_alarms", f"WITH mt AS MATERIALIZED ({_METRICS_SQL}) SELECT alarm, "
       "'2024-01-01 00:' || lpad(p::VARCHAR, 2, '0') || ':00' AS period_start, "
       "round(v, 4) AS statistic_value, b AS breaching, state FROM ("
       + " UNION ALL ".join(_default_sql(a) for a in m.DEFAULT_ALARMS) + ")")
def _(spark, sf_dir):
    metrics = settle(_both(spark, sf_dir, _RENAMED), "published")
    later = metrics.withColumn("ts", F.col("ts") + F.expr("INTERVAL 10 MINUTES"))
    states = m.alarm_states(metrics.unionByName(later), m.DEFAULT_ALARMS)
    return _text(states).withColumn("statistic_value", F.round("statistic_value", 4))
