"""Publication after the verdict, and the sink of metric groups."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from assayframe.operators import rules as r
from assayframe.operators.analyzers import Analyzer
from assayframe.sources import metric_sink as ms, publishing as pub
from assayframe.streaming import streams as st


def test_nothing_is_seen_before_publication(spark, tmp_path):
    folder = str(tmp_path / "t")
    assert pub.published(spark, folder) is None
    one = pub.stage(spark.range(3), folder, 0)
    assert pub.published(spark, folder) is None
    pub.publish(spark, folder, 0, one, "pass")
    pub.stage(spark.range(100), folder, 1)  # a run that ends here
    assert pub.published(spark, folder).count() == 3
    again = pub.stage(spark.range(5), folder, 1)
    pub.publish(spark, folder, 1, again, "quarantine")
    got = {(x["batch"], x["decision"]): x["count"] for x in
           pub.published(spark, folder).groupBy("batch", "decision").count().collect()}
    assert got == {(0, "pass"): 3, (1, "quarantine"): 5}
    assert pub.published(spark, folder, "pass").count() == 3
    third = pub.stage(spark.range(7), folder, 1)  # the batch is run again
    pub.publish(spark, folder, 1, third, "pass")
    assert pub.published(spark, folder, "pass").count() == 10
    assert pub.published(spark, folder, "quarantine") is None


def test_gate_stream_that_fails_midway(spark, tmp_path, monkeypatch):
    source, target, progress, history = (str(tmp_path / n) for n in ("in", "out", "cp", "h"))

    def run():
        rows = st.read_files(spark, f"{source}/*", "id long, v double")
        return st.once(st.gate_stream(rows, [r.row_count(least=1)], "t", target, progress,
                                      watched=[Analyzer("mean", "v")], history=history))

    for i in range(7):
        value = 500.0 if i == 6 else float(i % 2)
        spark.range(4).withColumn("v", F.lit(value)).write.parquet(f"{source}/{i}")
        if i == 5:
            real = pub.publish
            monkeypatch.setattr(pub, "publish", lambda *a, **k: 1 / 0)
            with pytest.raises(Exception, match="division by zero"):
                run()
            monkeypatch.setattr(pub, "publish", real)
            assert st.gated(spark, target).count() == 20
        run()
    got = {x["batch"]: (x["decision"], x["count"]) for x in
           st.gated(spark, target).groupBy("batch", "decision").count().collect()}
    assert got == {i: ("quarantine" if i == 6 else "pass", 4) for i in range(7)}
    seen = st.reviews(spark, target).collect()
    assert [(x["batch"], x["metric"], x["actual"]) for x in seen] == [(6, "Column.v.Mean", 500.0)]
    assert seen[0]["lower"] < 0.5 < seen[0]["upper"] < 500


def metrics(spark, n, space="a"):
    return spark.range(n).select(
        F.lit(space).alias("namespace"), F.concat(F.lit("m"), "id").alias("name"),
        F.col("id").cast("double").alias("value"), F.lit("Count").alias("unit"),
        F.timestamp_seconds("id").alias("ts"),
        F.create_map(F.lit("k"), F.lit("é")).alias("dimensions"))


def names(df):
    return sorted(x["name"] for x in df.select(F.inline("metrics")).collect())


def test_metric_groups(spark, tmp_path):
    folder = str(tmp_path / "m")
    df = metrics(spark, 105).repartition(3).union(metrics(spark, 3, "b").coalesce(1))
    ms.write_metric_groups(df, folder)
    back = ms.read_metric_groups(spark, folder)
    assert names(back) == sorted(x["name"] for x in df.collect())
    for g in back.collect():
        assert len(g["metrics"]) == g["metric_count"] <= 20
    first = back.select(F.inline("metrics")).where("name = 'm7'").first()
    assert first["value"] == 7.0 and first["dimensions"] == {"k": "é"} and first["ts"].timestamp() == 7
    # Files that no commit names are not read, as those of a try that failed.
    stray = next(iter(glob.glob(f"{folder}/groups/*.json")))
    with open(stray) as f, open(f"{folder}/groups/stray.json", "w") as out:
        out.write(f.read())
    assert names(ms.read_metric_groups(spark, folder)) == names(back)
    ms.write_metric_groups(metrics(spark, 0), folder)
    ms.write_metric_groups(metrics(spark, 2), folder, size=1)
    assert len(names(ms.read_metric_groups(spark, folder))) == 110


def test_failed_write_commits_nothing(spark, tmp_path):
    folder = str(tmp_path / "m")
    bad = metrics(spark, 50).repartition(2).withColumn(
        "value", F.when(F.col("name") == "m49", F.raise_error(F.lit("boom")).cast("double"))
        .otherwise(F.col("value")))
    with pytest.raises(Exception, match="boom"):
        ms.write_metric_groups(bad, folder)
    assert not glob.glob(f"{folder}/commits/*.json")


def test_stream_of_metric_groups(spark, tmp_path):
    source, folder, progress = (str(tmp_path / n) for n in ("in", "m", "cp"))
    ms.register(spark)
    schema = metrics(spark, 1).schema
    for i in range(2):
        metrics(spark, 30 + i).write.parquet(f"{source}/{i}")
        st.once(st.read_files(spark, f"{source}/*", schema).writeStream.format(ms.FORMAT)
                .option("path", folder).option("checkpointLocation", progress)
                .trigger(availableNow=True).start())
    commits = sorted(glob.glob(f"{folder}/commits/*.json"))
    assert [json.load(open(c))["metrics"] for c in commits] == [30, 31]
    assert len(names(ms.read_metric_groups(spark, folder))) == 61
