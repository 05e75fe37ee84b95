"""Input that the library's own writers would not make, and values at the edge of types."""

import csv
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from assayframe.operators import (
    analyzers as an, entities as en, gates, metrics as m, payloads, routing, rules as r,
    validation as v,
)
from assayframe.sources import readers, writers


def test_csv_as_others_write_it(spark, tmp_path):
    rows = [["name", "age", "temperature_f"], ['Ann "Bee" Lee, Jr', "50", "98.6"],
            ["two\nlines", "3.0", "98.6F"], ["", " 7 ", "1e2"], ["x", "37d", "nan"]]
    with open(tmp_path / "a.csv", "w", newline="") as f:
        csv.writer(f).writerows(rows)
    got = [tuple(x) for x in readers.read_csv_typed(spark, str(tmp_path / "a.csv")).collect()]
    assert got[:3] == [('Ann "Bee" Lee, Jr', 50, 98.6), ("two\nlines", None, None), ("", 7, 100.0)]
    assert got[3][:2] == ("x", None) and got[3][2] != got[3][2]


def test_stay_in_words_is_a_bad_format(spark, tmp_path):
    base = {"admission_date": "2024-01-01", "discharge_date": "2024-01-03"}
    rows = [{"record_id": i, "length_of_stay_days": s, **base} for i, s in
            enumerate([2, "two", "2", None, 9])]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    df = readers.read_json_strict(spark, str(tmp_path / "a.json"))
    checked = v.validate(df, "full", "2025-01-01")
    got = {x["record_id"]: {i["type"] for i in x["_validation"]["issues"]} & {
        "INVALID_DATE_FORMAT", "LOS_MISMATCH"} for x in checked.collect()}
    assert got == {0: set(), 1: {"INVALID_DATE_FORMAT"}, 2: {"INVALID_DATE_FORMAT"}, 3: set(),
                   4: {"LOS_MISMATCH"}}


def test_vital_with_a_unit_is_no_number(spark):
    df = spark.createDataFrame([(1, ("98.6F",)), (2, ("98.6",)), (3, ("37d",)), (4, (None,))],
                               "record_id int, vitals_at_discharge struct<temperature_f:string>")
    got = {x["record_id"]: [i["type"] for i in x["_validation"]["issues"]
                            if i["type"] == "INVALID_VITAL_VALUE"]
           for x in v.validate(df, "full", "2025-01-01").collect()}
    assert {k for k, found in got.items() if found} == {1, 3}


def test_constant_metrics_are_no_anomaly(spark):
    def history(values):
        return spark.createDataFrame([("t", f"{i:03d}", None, "m", x) for i, x in
                                      enumerate(values)], "table_name string, run_id string, "
                                     "run_ts timestamp, metric string, value double")

    for value in (98.6, 0.1, 0.7):
        assert an.observations(history([value] * 30)).count() == 0
    assert an.observations(history([98.6] * 10 + [98.7])).count() == 1


def test_advised_rules_pass_on_their_table(spark):
    df = spark.createDataFrame(
        [(9007199254740993 + i, i / 1000, float("nan") if i == 2 else 1.5, "ab"[i % 2], None)
         for i in range(5)], "id bigint, small double, gap double, kind string, none string")
    advised = {(x["column"], x["type"]): x["rule"] for x in an.recommend(df).collect()}
    assert "9007199254740993 and 9007199254740997" in advised[("id", "Range")]
    assert "between 0.0 and 0.004 " in advised[("small", "Range")]
    assert "between 1.5 and 1.5 " in advised[("gap", "Range")]
    assert advised[("kind", "ValueSet")] == 'ColumnValues "kind" in ["a", "b"]'
    low, high = (float(x) for x in advised[("small", "Statistical")].split("between ")[1]
                 .split(" and "))
    results = r.evaluate(df, [r.value_range("small", 0.0, 0.004),
                              r.value_range("id", 9007199254740993, 9007199254740997),
                              r.stddev_between("small", low, high)], "t").collect()
    assert [x["outcome"] for x in results] == ["PASS"] * 3
    assert ("kind", "ValueSet") not in {(x["column"], x["type"]) for x in
                                        an.recommend(df, value_set_size=1).collect()}


def test_errors_stay_in_their_rule(spark):
    df = spark.range(5).toDF("k")
    out = r.evaluate(df, [
        r.row_count(equal=5), r.custom_sql("SELECT 1 / (count(*) - 5) FROM primary", "=", 1),
        r.custom_sql("SELECT k FROM primary", "<=", 9), r.custom_sql("SELECT nope FROM", "=", 1),
        r.custom_sql("WITH x AS (SELECT * FROM primary) SELECT sum(k) FROM x", "=", 10)], "t")
    assert [x["outcome"] for x in out.collect()] == ["PASS", "ERROR", "ERROR", "ERROR", "PASS"] \
        or sorted(x["outcome"] for x in out.collect()) == ["ERROR"] * 3 + ["PASS"] * 2
    counts = {x["outcome"]: x["rules"] for x in r.outcome_counts(out).collect()}
    assert counts == {"PASS": 2, "ERROR": 3}


def test_whole_values_on_rejected_rows(spark):
    df = spark.createDataFrame([(1, "x" * 200)], "k int, s string")
    rules = [r.pattern("s", "[0-9]+"), r.length_min("s", 300)]
    values = [t["value"] for t in routing.route_rows(df, rules).first()["violated"]]
    assert values == ["x" * 200, "x" * 200 + " (length 200)"]
    shown = [x["value"] for x in r.violations(df, rules, "t", "k").orderBy("rule_id").collect()]
    assert shown == ["x" * 80, "x" * 50 + " (length 200)"]


def test_alarms_are_checked_and_compared(spark):
    for bad in ({"statistic": "p99"}, {"compare": "=>"}, {"missing": "ignore"}, {"periods": 0}):
        with pytest.raises(ValueError):
            m.Alarm("a", "x", **bad)
    df = spark.createDataFrame([("x", 100.0, 0), ("x", 100.0, 100), ("x", 5.0, 700)],
                               "name string, value double, s long").select(
        "name", "value", F.timestamp_seconds("s").alias("ts"),
        F.create_map().cast("map<string,string>").alias("dimensions"))
    alarms = [m.Alarm("count", "x", {}, "SampleCount", ">=", 2.0),
              m.Alarm("at", "x", {}, "Maximum", "<=", 5.0)]
    got = {(x["alarm"], x["period_start"].timestamp()): (x["statistic_value"], x["state"])
           for x in m.alarm_states(df, alarms).collect()}
    assert got == {("count", 0): (2.0, "ALARM"), ("count", 300): (None, "OK"),
                   ("count", 600): (1.0, "OK"), ("at", 0): (100.0, "OK"), ("at", 300): (None, "OK"),
                   ("at", 600): (5.0, "ALARM")}
    assert m.alarm_states(df.limit(0), alarms).count() == 0


def test_keys_pass_beside_an_extractor(spark):
    df = spark.createDataFrame([(9007199254740993, "a"), (None, "b"), (1, None)], "k long, t string")
    out = en.with_custom_entities(df, "t", lambda s: pd.Series([[] for _ in s]))
    assert sorted(str(x["k"]) for x in out.collect()) == ["1", "9007199254740993", "None"]


def test_one_payload_per_conversation(spark):
    df = spark.range(2500).selectExpr("1 AS conv_id", "id AS turn", "'user' AS role",
                                      "string(id) AS text")
    assert [x["messages"] for x in payloads.chat_payload(df).collect()] == [2500]
    parts = payloads.chat_payload(df, max_messages=1000).orderBy("part").collect()
    assert [x["messages"] for x in parts] == [1000, 1000, 500]


def test_json_arrays(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "if(id = 3, null, concat('é\"', id)) AS s")
    writers.write_json_arrays(df.repartition(3), str(tmp_path / "a"))
    for f in (tmp_path / "a").glob("part-*.txt"):
        json.loads(f.read_text())
    back = readers.read_json_array(spark, str(tmp_path / "a"), "id bigint, s string")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_register_reads_arrays(spark, tmp_path):
    (tmp_path / "lake").mkdir()
    (tmp_path / "lake/list.json").write_text('[{"a": 1},\n {"a": 2}]')
    spark.range(3).write.parquet(str(tmp_path / "lake/nums.parquet"))
    found = {(x["table_name"], x["column"]) for x in readers.register_tables(
        spark, str(tmp_path / "lake")).collect()}
    assert found == {("list_json", "a"), ("nums_parquet", "id")}
    assert spark.table("list_json").count() == 2


def test_score_searches_for_nothing_else(spark):
    df = spark.createDataFrame([(1, "Plan: aspirin daily.")], "k int, note string")
    plan = gates.with_relevance(df, "note").select("relevance_score")._jdf.queryExecution() \
        .optimizedPlan().toString()
    assert "poor" not in plan and "_signal_profanity" not in plan and "_signal_phi" not in plan
