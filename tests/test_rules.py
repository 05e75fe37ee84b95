"""Rules on edge frames and against a row-wise statement of each rule."""

import random
import re
import statistics
from datetime import datetime

import pytest

from assayframe.operators import analyzers as an, rules as r, rulesets

SCHEMA = ("record_id bigint, name string, age bigint, temp double, start string, end string, "
          "code string, tags array<string>, v struct<x:bigint>")


def rows_of(n, seed):
    rnd = random.Random(seed)
    return [(rnd.choice([None, *range(8)]), rnd.choice([None, "", "None", "  ", "a", "bb", "é😀"]),
             rnd.choice([None, -5, 0, 60, 120, 121]),
             rnd.choice([None, float("nan"), float("inf"), 36.6, 90.0, 108.0]),
             rnd.choice([None, "", "2024-1-5", "2024-02-30", "2024-03-01", "x", "2024-01-05z"]),
             rnd.choice([None, "2024-01-04", "2024-12-31", "12024-01-01"]),
             rnd.choice([None, "", "E11.9", "E11.999", "X00", "ZZ99.9", "E11\n"]),
             rnd.choice([None, [], ["a"]]), rnd.choice([None, (None,), (5,), (300,)]))
            for _ in range(n)]


RULES = {
    "complete": r.completeness("name", 0.5), "complete_num": r.completeness("age", 0.8),
    "range": r.value_range("age", 0, 120), "range_nulls": r.value_range("age", 0, 120, "fail"),
    "range_share": r.value_range("age", 0, 120, threshold=0.6),
    "nan": r.value_range("temp", 36.0, 108.0), "min": r.minimum("age", 0),
    "unique": r.unique("record_id"), "dates": r.date_order("start", "end"),
    "icd10": r.icd10("code"), "in": r.values_in("name", ["a", "bb", "  "]),
    "length": r.length_min("name", 2), "length_share": r.length_between("name", 1, 2, 0.5),
    "empty": r.array_not_empty("tags", 3), "nulls": r.null_count("tags", 3),
    "nested": r.nested_range("v.x", 0, 250), "mean": r.mean_between("age", 40, 80),
    "spread": r.stddev_max("age", 60), "rows": r.row_count(least=5),
}


def day(s):
    try:
        return datetime.strptime(s or "", "%Y-%m-%d")
    except ValueError:
        return None


def expected(rows):
    """(violations, passed) of each rule, stated row by row."""
    rid, name, age, temp, start, end, code, tags, v = (list(c) for c in zip(*rows)) if rows \
        else ([] for _ in range(9))
    n = len(rows)

    def share(bad, checked, threshold=None):
        if threshold is None:
            return bad, bad == 0
        return bad, ((checked - bad) / checked if checked else 0) >= threshold

    def count(values, test):
        return sum(1 for x in values if test(x))

    ages = [a for a in age if a is not None]
    off = count(ages, lambda a: a < 0 or a > 120)
    missing = count(name, lambda x: x in (None, "", "None"))
    temps = count(temp, lambda t: t is not None and (t < 36.0 or t > 108.0))
    late = sum(1 for s, e in zip(start, end) if day(s) and day(e) and day(e) < day(s))
    codes = [c for c in code if c]
    bad_codes = count(codes, lambda c: not re.match(r"^[A-Z]\d{2}(\.\d{1,2})?$", c))
    texts = [x for x in name if x]
    keys = [k for k in rid if k is not None]
    xs = [s[0] for s in v if s is not None and s[0] is not None]
    return {
        "complete": share(missing, n, 0.5),
        "complete_num": share(n - len(ages), n, 0.8),
        "range": share(off, len(ages)), "range_nulls": share(off + n - len(ages), n),
        "range_share": share(off, len(ages), 0.6), "nan": share(temps, n),
        "min": share(count(ages, lambda a: a < 0), n),
        "unique": (len(keys) - len(set(keys)), len(keys) == len(set(keys))),
        "dates": share(late, n), "icd10": share(bad_codes, len(codes), 0.9),
        "in": share(count([x for x in name if x is not None],
                          lambda x: x not in ("a", "bb", "  ")), n),
        "length": share(count(texts, lambda x: len(x) < 2), n),
        "length_share": share(count(texts, lambda x: not 1 <= len(x) <= 2), len(texts), 0.5),
        "empty": (count(tags, lambda t: t == []), count(tags, lambda t: t == []) <= 3),
        "nulls": (tags.count(None), tags.count(None) <= 3),
        "nested": share(count(xs, lambda x: x < 0 or x > 250), n),
        "mean": (None, bool(ages) and 40 <= statistics.mean(ages) <= 80),
        "spread": (None, len(ages) > 1 and statistics.stdev(ages) <= 60),
        "rows": (None, n >= 5),
    }


@pytest.mark.parametrize("n,seed,parts", [(0, 0, 1), (1, 1, 1), (4, 2, 2), (60, 3, 1), (60, 3, 7),
                                          (400, 4, 3)])
def test_rules_equal_the_row_wise_statement(spark, n, seed, parts):
    rows = rows_of(n, seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = {list(RULES)[x["rule_id"] - 1]: (x["violations"], x["outcome"] == "PASS")
           for x in r.evaluate(df, list(RULES.values()), "t").collect()}
    assert got == expected(rows)


def test_all_null_columns(spark):
    df = spark.createDataFrame([(None,) * 9] * 3, SCHEMA)
    got = {list(RULES)[x["rule_id"] - 1]: x["outcome"]
           for x in r.evaluate(df, list(RULES.values()), "t").collect()}
    assert got["unique"] == got["range"] == got["dates"] == got["empty"] == "PASS"
    assert got["complete"] == got["icd10"] == got["mean"] == got["spread"] == "FAIL"


def test_rules_that_cannot_run_are_errors(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    bad = [r.completeness("gone", 1), r.mean_between("b", 0, 1), r.where_count("no_such(b) = 1"),
           r.unique("gone"), r.custom_sql("SELECT count(*) FROM primary WHERE gone = 1", "=", 0),
           r.array_not_empty("b"), r.row_count(equal=1)]
    out = sorted(r.evaluate(df, bad, "t").collect(), key=lambda x: x["rule_id"])
    assert [x["outcome"] for x in out] == ["ERROR"] * 6 + ["PASS"]
    assert r.score(r.evaluate(df, bad, "t")).first()["rules_failed"] == 6


def test_violations_are_the_first_by_key_and_names_may_need_quotes(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "`row id` int, `the value` int")
    got = r.violations(df.repartition(5), [r.value_range("the value", 0, 1)], "t", "row id", 4)
    assert [x["record_id"] for x in got.orderBy("rank").collect()] == ["2", "5", "8", "11"]


def test_custom_sql_and_fused_condition_agree(spark):
    df = spark.createDataFrame([(1, []), (2, ["a"]), (3, None)], "k int, tags array<string>")
    out = r.evaluate(df, [
        r.custom_sql("SELECT COUNT(*) FROM primary WHERE size(tags) = 0", "=", 1),
        r.where_count("size(tags) = 0", 1)], "t").collect()
    assert {x["metric"] for x in out} == {1.0} and {x["outcome"] for x in out} == {"PASS"}


def test_rule_sets_have_the_declared_sizes(spark):
    assert [len(s()) for s in (rulesets.flat_records, rulesets.nested_records,
                               rulesets.notes)] == [19, 23, 14]


def test_fused_rules_scan_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(rows_of(20, 9), SCHEMA).write.parquet(path)
    fused = [x for k, x in RULES.items() if k != "unique"]
    plan = r.evaluate(spark.read.parquet(path), fused, "t")._jdf.queryExecution()
    assert plan.executedPlan().toString().count("FileScan") == 1


def test_hot_key_uniqueness(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 0, id) AS k").repartition(6)
    out = r.evaluate(df, [r.unique("k")], "t").first()
    assert (out["total"], out["violations"], out["outcome"]) == (3000, 999, "FAIL")


def test_recommended_rules_hold_on_their_table(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], float(i), None) for i in range(40)],
                               "k bigint, s string, x double, e string")
    rules = {x["rule"] for x in an.recommend(df).collect()}
    assert 'ColumnValues "s" in ["a", "b"]' in rules
    assert 'ColumnValues "k" between 0 and 39 with threshold >= 0.95' in rules
    assert 'RowCount between 20 and 60' in rules and 'IsComplete "e"' not in rules


def test_recommend_on_an_empty_table(spark):
    df = spark.createDataFrame([], "k bigint, s string")
    assert "RowCount" in {x["type"] for x in an.recommend(df).collect()}


def test_observations_need_five_runs_and_any_change_without_spread(spark):
    rows = [("t", f"r{i}", i, "m", v) for i, v in enumerate([5.0] * 5 + [5.0, 6.0])]
    df = spark.createDataFrame(rows, "table_name string, run_id string, n int, metric string, "
                                     "value double").selectExpr(
        "table_name", "run_id", "timestamp_seconds(n) AS run_ts", "metric", "value")
    assert [x["run_id"] for x in an.observations(df).collect()] == ["r6"]


def test_exact_and_approximate_distinct(spark):
    df = spark.range(50).selectExpr("id % 5 AS g", "cast(null AS int) AS z")
    got = {x["metric"]: x["value"] for x in an.analyze(df, [
        an.Analyzer("distinct", "g"), an.Analyzer("distinct", "z"), an.Analyzer("row_count")],
        "t").collect()}
    assert got == {"Column.g.DistinctValuesCount": 5, "Column.z.DistinctValuesCount": 0,
                   "Dataset.*.RowCount": 50}
