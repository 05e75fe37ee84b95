"""Whole jobs over records and notes derived from the driver tables."""

import json

from pyspark.sql import functions as F

from assayframe.operators import metrics as m, records, rules as r, rulesets
from assayframe.plans import derived, jobs

SF = "/root/testdata/sf0.001"


def test_quality_run(spark, tmp_path):
    rec = derived.records(spark, SF)
    results = jobs.quality_run({
        "patient_records_csv": (records.flatten(rec), rulesets.flat_records()),
        "patient_records_json": (rec, rulesets.nested_records()),
        "clinical_notes_json": (derived.notes(spark, SF), rulesets.notes())},
        str(tmp_path / "report"), "run-1")
    scores = {x["table_name"]: x["total_rules"] for x in r.score(results).collect()}
    assert scores == {"patient_records_csv": 19, "patient_records_json": 23,
                      "clinical_notes_json": 14}
    total = r.score_all(results).where("table_name is null").first()
    assert total["total_rules"] == 56
    saved = [json.loads(line) for p in (tmp_path / "report/summary").glob("*.json")
             for line in p.read_text().splitlines()]
    assert any(x["total_rules"] == 56 for x in saved)


def test_validation_then_payloads(spark, tmp_path):
    rec, notes = derived.records(spark, SF), derived.notes(spark, SF)
    kept = jobs.validation_run(rec, notes, "seq", str(tmp_path / "v"), as_of=derived.AS_OF)
    good = kept.where(F.col("_validation.status") != "FAIL").count()
    out = jobs.payload_run(rec, kept, notes, "seq")
    rows = out.select("record_id", "payload.body", "entities.phi_detected").collect()
    assert len(rows) == good > 0
    assert json.loads(rows[0]["body"])["messages"][0]["role"] == "user"
    metrics = m.validation_metrics(m.tally(kept), F.current_timestamp())
    by_name = {x["name"]: x["value"] for x in metrics.collect()}
    assert by_name["Validation_ErrorCount"] == kept.count() - good
    assert spark.read.parquet(str(tmp_path / "v/clean")).count() == good


def test_governed_run_goes_on_from_the_last(spark, tmp_path):
    from assayframe.operators import rules as r
    from assayframe.operators.analyzers import Analyzer
    from assayframe.operators.metrics import Alarm
    from assayframe.plans import jobs
    from assayframe.sources import metric_sink as ms

    path, folder = str(tmp_path / "t"), str(tmp_path / "runs")
    ruleset = [r.value_range("v", 0, 10), r.row_count(least=1)]
    alarms = [Alarm("low", "GlueDQ_OverallScore", {}, "Average", "<", 80.0, 1, 86400)]

    def run(i):
        return jobs.governed_run(spark, path, ruleset, "t", folder, f"r{i}",
                                 f"2024-01-0{i + 1} 00:00:00", [Analyzer("mean", "v")], alarms,
                                 least_runs=2).first()

    got = []
    for i, value in enumerate([1.0, 1.0, 1.0, 99.0]):
        spark.createDataFrame([(value,)] * 3, "v double").coalesce(1).write.mode("append").parquet(path)
        got.append(run(i))
    assert [(x["run_id"], x["decision"], x["observations"]) for x in got] == [
        ("r0", "pass", 0), ("r1", "pass", 0), ("r2", "pass", 0), ("r3", "quarantine", 1)]
    seen = spark.read.parquet(f"{folder}/reviews/run=r3").first()
    assert seen["actual"] == 25.5 and seen["lower"] == seen["upper"] == 1.0
    sent = ms.read_metric_groups(spark, f"{folder}/metrics")
    before = sum(x["metric_count"] for x in sent.collect())
    changes = spark.read.parquet(f"{folder}/alarm-changes").orderBy("period_start").collect()
    assert [(x["alarm"], x["state"]) for x in changes] == [("low", "OK"), ("low", "ALARM")]
    again = run(4)  # nothing has changed: the last decision, and nothing is sent
    assert again == got[-1]
    assert sum(x["metric_count"] for x in ms.read_metric_groups(spark, f"{folder}/metrics")
               .collect()) == before


def test_code_of_records_can_be_compiled(spark, capsys):
    """The JVM leaves methods of over 8,000 bytes of code uncompiled."""
    import re

    from assayframe.plans import derived
    orders = spark.range(100).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "'F' AS o_orderstatus",
        "timestamp_ntz'1995-01-01 00:00:00' AS o_orderdate")
    derived.records_of(orders).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000
