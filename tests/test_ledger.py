"""The run ledger, mergeable states and running bounds."""

import glob
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from assayframe.operators import analyzers as an, ledger, rules as r, states

RULES = [r.completeness("name", 0.9), r.value_range("age", 0, 100), r.unique("key"),
         r.unique("key", "name"), r.mean_between("age", 20, 60), r.stddev_max("age", 40),
         r.stddev_between("price", 1, 2), r.row_count(least=5), r.null_count("age", 3),
         r.values_in("name", ["a", "b"]), r.pattern("name", "[a-z]", 0.5),
         r.where_count("age > price", 2), r.completeness("nope", 1.0),
         r.value_range("age", 0, 100, null_policy="fail"), r.mean_between("name", 0, 1),
         r.custom_sql("SELECT count(*) FROM primary WHERE age > 50", "<=", 4)]
SCHEMA = "key long, name string, age int, price double"


def rows(rnd, n):
    return [(rnd.randrange(50), rnd.choice(["a", "b", "", None, "None", "zz"]),
             rnd.choice([None, rnd.randrange(120)]), 1e9 + rnd.random()) for _ in range(n)]


def shown(df):
    return sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in row)
                  for row in df.drop("run_id").collect())


def spoil(path):
    """Other bytes under the same names, lengths and times: reading them would fail."""
    for f in glob.glob(f"{path}/*.parquet"):
        stat = os.stat(f)
        with open(f, "wb") as out:
            out.write(b"\0" * stat.st_size)
        os.utime(f, ns=(stat.st_atime_ns, stat.st_mtime_ns))
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.remove(crc)


@pytest.fixture
def table(spark, tmp_path):
    path, rnd = str(tmp_path / "t"), random.Random(4)

    def add(n):
        spark.createDataFrame(rows(rnd, n), SCHEMA).coalesce(1).write.mode("append").parquet(path)

    return path, str(tmp_path / "ledger"), add


def test_grown_table_equals_full_run(spark, table):
    path, folder, add = table
    for i, n in enumerate([30, 0, 12, 1]):
        add(n)
        got = ledger.evaluate(spark, path, RULES, "t", folder, f"run-{i}")
        want = r.evaluate(spark.read.schema(SCHEMA).parquet(path), RULES, "t")
        assert shown(got) == shown(want), i
    # A file that is gone drops out.
    os.remove(sorted(glob.glob(f"{path}/*.parquet"), key=os.path.getsize)[-1])
    got = ledger.evaluate(spark, path, RULES, "t", folder, "run-9")
    assert shown(got) == shown(r.evaluate(spark.read.schema(SCHEMA).parquet(path), RULES, "t"))


def test_old_files_are_not_read(spark, table):
    path, folder, add = table
    rules = [x for x in RULES if not x.sql]
    add(40)
    first = shown(ledger.evaluate(spark, path, rules, "t", folder, "one"))
    before = set(glob.glob(f"{path}/*.parquet"))
    full = spark.createDataFrame(spark.read.parquet(path).collect(), SCHEMA)
    spoil(path)
    again = ledger.evaluate(spark, path, rules, "t", folder, "two")
    assert shown(again) == first
    assert {x["run_id"] for x in again.collect()} == {"one"}
    add(15)
    new = [f for f in glob.glob(f"{path}/*.parquet") if f not in before]
    want = full.unionByName(spark.read.schema(SCHEMA).parquet(*new))
    # The schema comes from any file's footer: a new one, as those of old files are spoilt.
    spark.conf.set("spark.sql.files.ignoreCorruptFiles", "true")
    try:
        got = ledger.evaluate(spark, path, rules, "t", folder, "three")
    finally:
        spark.conf.unset("spark.sql.files.ignoreCorruptFiles")
    assert shown(got) == shown(r.evaluate(want, rules, "t"))


def test_schema_is_found_behind_a_corrupt_file(spark, table):
    path, folder, add = table
    rules = [x for x in RULES if not x.sql]
    add(40)
    [old] = glob.glob(f"{path}/*.parquet")
    os.rename(old, f"{path}/part-0.parquet")  # the first by name, of which Spark reads the footer
    ledger.evaluate(spark, path, rules, "t", folder, "one")
    full = spark.createDataFrame(spark.read.parquet(path).collect(), SCHEMA)
    spoil(path)
    add(15)
    [new] = glob.glob(f"{path}/part-00000*.parquet")
    want = full.unionByName(spark.read.schema(SCHEMA).parquet(new))
    spark.conf.set("spark.sql.files.ignoreCorruptFiles", "true")
    try:
        got = ledger.evaluate(spark, path, rules, "t", folder, "two")
    finally:
        spark.conf.unset("spark.sql.files.ignoreCorruptFiles")
    assert shown(got) == shown(r.evaluate(want, rules, "t"))


def test_run_that_ended_midway_does_not_count(spark, table):
    path, folder, add = table
    add(20)
    ledger.evaluate(spark, path, RULES, "t", folder, "one")
    shutil.rmtree(f"{folder}/runs")  # as if it had ended before its last step
    assert ledger.last_run(spark, folder, "t") is None
    add(5)
    got = ledger.evaluate(spark, path, RULES, "t", folder, "two")
    assert shown(got) == shown(r.evaluate(spark.read.schema(SCHEMA).parquet(path), RULES, "t"))


def test_other_rules_are_a_run_of_their_own(spark, table):
    path, folder, add = table
    add(20)
    ledger.evaluate(spark, path, RULES[:3], "t", folder, "one")
    got = ledger.evaluate(spark, path, RULES[1:5], "t", folder, "two")
    assert shown(got) == shown(r.evaluate(spark.read.schema(SCHEMA).parquet(path), RULES[1:5], "t"))


@pytest.mark.parametrize("sizes", [(1, 1), (40, 3, 0), (0, 0), (200,)])
def test_merged_states_equal_whole(spark, sizes):
    rnd = random.Random(sum(sizes))
    parts = [rows(rnd, n) for n in sizes]
    whole = spark.createDataFrame([x for p in parts for x in p], SCHEMA)
    found = None
    for p in parts:
        one = states.states(spark.createDataFrame(p, SCHEMA))
        found = one if found is None else found.unionByName(one)
    got = {r["metric"]: r["value"] for r in states.metrics_of(states.merge(found)).collect()}
    want = {r["metric"]: r["value"] for r in states.metrics_of(states.states(whole)).collect()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        # Values near 10^9 with a spread below 1: sums of squares would have lost it.
        assert (v is None and got[k] is None) or got[k] == pytest.approx(v, rel=1e-6, abs=1e-9), k
    if sum(sizes):
        exact = an.analyze(whole, [an.Analyzer("stddev", "price"), an.Analyzer("mean", "price"),
                                   an.Analyzer("distinct", "name")], "t").collect()
        for x in exact:
            if x["value"] is not None:  # no deviation of one value
                assert got[x["metric"]] == pytest.approx(x["value"], rel=1e-6)


def test_running_bounds_equal_history(spark):
    rnd = random.Random(3)
    data = [("t", f"{i:02d}", m, v) for i in range(12) for m in ("x", "flat", "gap")
            for v in [{"x": rnd.gauss(5, 1) if i != 9 else 50.0, "flat": 2.5 if i < 10 else 2.6,
                       "gap": None if i % 3 == 0 else float(i)}[m]]]
    runs = spark.createDataFrame(data, "table_name string, run_id string, metric string, value double") \
        .withColumn("run_ts", F.to_timestamp(F.concat(F.lit("2024-01-"), F.lpad(
            (F.col("run_id").cast("int") + 1).cast("string"), 2, "0"))))
    history, got = states.no_history(spark), []
    for i in range(12):
        seen, new = states.observe(history, runs.where(F.col("run_id") == f"{i:02d}"))
        got += [(x["run_id"], x["metric"], x["actual"], round(x["lower"], 6)) for x in seen.collect()]
        history = spark.createDataFrame(new.collect(), new.schema)
    want = [(x["run_id"], x["metric"], x["actual"], round(x["lower"], 6))
            for x in an.observations(runs).collect()]
    assert sorted(got) == sorted(want) and got
