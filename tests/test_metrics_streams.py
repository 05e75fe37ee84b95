"""Metrics, alarms, sinks and streams."""

import os
import time

import pytest
from pyspark.sql import functions as F

from assayframe.operators import metrics as m, routing, rules as r
from assayframe.session import fresh_path, shared_dir
from assayframe.sources import readers, writers
from assayframe.streaming import streams as st

METRICS = "name string, value double, ts timestamp, dimensions map<string,string>, " \
          "namespace string, unit string"


def readings(spark, rows):
    df = spark.createDataFrame(rows, "name string, value double, s long, "
                                     "dimensions map<string,string>")
    return df.select("name", "value", F.timestamp_seconds("s").alias("ts"), "dimensions",
                     F.lit("n").alias("namespace"), F.lit("Count").alias("unit"))


def states(df, alarms, *span):
    return [(x["statistic_value"], x["breaching"], x["state"]) for x in m.alarm_states(
        df, alarms, *span).orderBy("period_start").collect()]


def test_alarm_counts_consecutive_periods_and_missing_ones(spark):
    df = readings(spark, [("s", 70.0, 0, {"Dataset": "a", "Pipeline": "p"}),
                          ("s", 90.0, 100, {"Dataset": "a"}), ("s", 60.0, 700, {"Dataset": "a"}),
                          ("s", 99.0, 1300, {"Dataset": "a"}), ("s", 1.0, 1300, {"Dataset": "b"})])
    alarm = m.Alarm("x", "s", {"Dataset": "a"}, "Average", "<", 80.0, 2, missing="breaching")
    assert states(df, [alarm], 0, 1799) == [
        (80.0, False, "OK"), (None, True, "OK"), (60.0, True, "ALARM"), (None, True, "ALARM"),
        (99.0, False, "OK"), (None, True, "OK")]
    strict = m.Alarm("x", "s", {"Dataset": "a"}, "Sum", ">", 1.0, 1, strict=True)
    assert states(df, [strict], 0, 599) == [(90.0, True, "ALARM"), (None, False, "OK")]
    assert states(df.where("1 = 0"), [alarm]) == []


def test_default_alarms_and_series(spark):
    df = readings(spark, [("Validation_ErrorCount", 21.0, 10, m.VALIDATOR),
                          ("Validation_ErrorsByType", 6.0, 10,
                           {"ErrorType": "DRUG_INTERACTION", **m.VALIDATOR})])
    got = {x["alarm"]: x["state"] for x in m.alarm_states(df, m.DEFAULT_ALARMS, 0, 10).collect()}
    assert list(got.values()).count("ALARM") == 2
    assert m.type_series(df).first()["DRUG_INTERACTION"] == 6.0


def test_batches_of_twenty(spark, tmp_path):
    df = readings(spark, [("m", float(i), i // 10, {}) for i in range(45)]).repartition(4)
    assert sorted(x["count"] for x in m.batches(df).groupBy("batch_id").count().collect()) == \
        [5, 20, 20]
    writers.write_metrics(df, str(tmp_path / "out"))
    rows = spark.read.json(str(tmp_path / "out")).orderBy("batch_id").collect()
    assert [x["metric_count"] for x in rows] == [20, 20, 5]


def test_results_append_by_day(spark, tmp_path):
    df = r.evaluate(spark.range(5).toDF("k"), [r.row_count(least=1), r.row_count(equal=9)], "t",
                    "r1")
    for day in ("2024-01-02", "2024-01-03"):
        writers.write_results(df, str(tmp_path / "res"), f"{day} 00:00:00")
    back = writers.read_results(spark, str(tmp_path / "res"))
    assert back.count() == 4 and back.where("day = '02' and outcome = 'FAIL'").count() == 1
    assert os.path.isdir(tmp_path / "res/table_name=t/year=2024/month=01/day=03")


def test_gate_decision(spark):
    score = spark.createDataFrame([("a", "1", 9, 10), ("b", "1", 8, 10), ("c", "1", 10, 10)],
                                  "table_name string, run_id string, rules_passed long, "
                                  "total_rules long")
    seen = spark.createDataFrame([("c", "1", "m")], "table_name string, run_id string, "
                                                    "metric string")
    got = {x["table_name"]: x["decision"] for x in routing.gate_decision(score, seen).collect()}
    assert got == {"a": "pass", "b": "quarantine", "c": "quarantine"}


def test_register_tables(spark, tmp_path):
    (tmp_path / "patient_records.csv").write_text("a,b\n1,x\n")
    (tmp_path / "clinical_notes.json").write_text('{"a": 1}\n')
    (tmp_path / "readme.txt").write_text("no")
    found = readers.register_tables(spark, str(tmp_path)).collect()
    assert {(x["table_name"], x["column"], x["type"]) for x in found} == {
        ("patient_records_csv", "a", "int"), ("patient_records_csv", "b", "string"),
        ("clinical_notes_json", "a", "bigint")}
    assert "patient_records_csv" in readers.list_tables(spark)


def test_shared_folder(spark):
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    assert fresh_path(spark, "x").startswith(shared_dir(spark))


@pytest.fixture
def arrivals(spark, tmp_path):
    """Three files in order: (key, seq, v) with later and earlier sequence numbers."""
    source = str(tmp_path / "in")
    for i, rows in enumerate([[(1, 1, "a"), (2, 5, "b")], [(1, 3, "c"), (2, 2, "old")],
                              [(1, 2, "late"), (3, 1, "d")]]):
        spark.createDataFrame(rows, "k int, seq int, v string").coalesce(1).write.mode(
            "append").parquet(source)
        time.sleep(1.1)
    return source


def test_last_wins_over_batches_and_restart(spark, tmp_path, arrivals):
    target, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    for _ in range(2):
        stream = st.read_files(spark, arrivals, "k int, seq int, v string", files_per_batch=1)
        st.once(st.last_wins_stream(stream, "k", "seq", target, progress))
    got = {x["k"]: x["v"] for x in st.current(spark, target, ["k"], "seq").collect()}
    assert got == {1: "c", 2: "b", 3: "d"}


def test_gate_stream_routes_each_batch(spark, tmp_path, arrivals):
    target = str(tmp_path / "out")
    stream = st.read_files(spark, arrivals, "k int, seq int, v string", files_per_batch=1)
    st.once(st.gate_stream(stream, [r.value_range("seq", 0, 4)], "t", target,
                           str(tmp_path / "progress")))
    got = {(x["batch"], x["decision"]): x["count"] for x in st.gated(spark, target).groupBy(
        "batch", "decision").count().collect()}
    assert got == {(0, "quarantine"): 2, (1, "pass"): 2, (2, "pass"): 2}


def test_late_rows_are_dropped(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for seconds in ([100_000, 100_001], [100_400], [10]):
        spark.createDataFrame([(s, 1.0) for s in seconds], "s long, value double").select(
            F.timestamp_seconds("s").alias("ts"), "value").coalesce(1).write.mode(
            "append").parquet(source)
        time.sleep(1.1)
    counter = st.DropCounter()
    spark.streams.addListener(counter)
    query = st.once(st.period_stream(
        st.read_files(spark, source, "ts timestamp, value double", files_per_batch=1), target,
        str(tmp_path / "progress"), F.col("value"), "10 minutes"))
    assert counter.of(query) == 1
    spark.streams.removeListener(counter)
    assert {x["n"] for x in st.current(spark, target, ["period_start"]).collect()} == {2, 1}
