"""Queries: rules, rule sets, scores, analyzers, recommendation, run history."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..operators import analyzers as an, ledger, records as rec_ops, rules as r, rulesets, states
from ..operators.joins import cross_table_dates
from ..session import fresh_path, settle
from . import derived
from .derived import quoted, with_ctes
from .registry import query, table

COLUMNS = ["rule_id", "rule", "type", "total", "checked", "violations", "metric", "outcome"]

# --- SQL for one rule ----------------------------------------------------------------------

_NULL = "CAST(NULL AS BIGINT)"


def rule_sql(rule: r.Rule, source: str, passed: str, checked="count(*)", violations=_NULL,
             metric="CAST(NULL AS DOUBLE)", total="count(*)", rule_id: int = 1) -> str:
    return (f"SELECT CAST({rule_id} AS BIGINT) AS rule_id, {quoted(rule.text)} AS rule, "
            f"{quoted(rule.type)} AS type, CAST({total} AS BIGINT) AS total, "
            f"CAST({checked} AS BIGINT) AS checked, CAST({violations} AS BIGINT) AS violations, "
            f"CAST({metric} AS DOUBLE) AS metric, "
            f"CASE WHEN {passed} THEN 'PASS' ELSE 'FAIL' END AS outcome FROM {source}")


def share_sql(rule, source, eligible, good, threshold=None, rule_id=1):
    """A rule on the share of eligible rows that are good."""
    n, g = f"count(*) FILTER ({eligible})", f"count(*) FILTER (({eligible}) AND ({good}))"
    share = f"(CASE WHEN {n} = 0 THEN 0.0::DOUBLE ELSE {g}::DOUBLE / {n} END)"
    passed = f"{n} = {g}" if threshold is None else f"{share} >= {threshold}"
    return rule_sql(rule, source, passed, n, f"{n} - {g}", f"round({share}, 4)",
                    rule_id=rule_id)


def filled(col):
    return f"({col} IS NOT NULL AND CAST({col} AS VARCHAR) NOT IN ('', 'None'))"


def unique_sql(rule, source, cols, rule_id=1):
    present = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    tuples = f"({', '.join(cols)})" if len(cols) > 1 else cols[0]
    n, u = f"count(*) FILTER ({present})", f"count(DISTINCT {tuples}) FILTER ({present})"
    return rule_sql(rule, source, f"{n} = {u}", n, f"{n} - {u}",
                    f"round(CASE WHEN {n} = 0 THEN 0.0 ELSE {u}::DOUBLE / {n} END, 4)", n,
                    rule_id)


def count_sql(rule, source, bad, most, checked="count(*)", rule_id=1):
    n = f"count(*) FILTER ({bad})"
    return rule_sql(rule, source, f"{n} <= {most}", checked, n, n, rule_id=rule_id)


def stat_sql(rule, source, col, value, test, rule_id=1):
    return rule_sql(rule, source, f"coalesce({test.format(v=value)}, false)", f"count({col})",
                    metric=f"round({value}, 2)", rule_id=rule_id)


def rows_sql(rule, source, test, rule_id=1):
    return rule_sql(rule, source, f"count(*) {test}", metric="count(*)", rule_id=rule_id)


DAY_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}$"


def day_sql(col):
    return (f"(CASE WHEN regexp_matches({col}, '{DAY_PATTERN}') "
            f"THEN CAST(try_strptime({col}, '%Y-%m-%d') AS DATE) END)")


def dates_sql(rule, source, rule_id=1):
    a, d = day_sql("admission_date"), day_sql("discharge_date")
    return share_sql(rule, source, f"{a} IS NOT NULL AND {d} IS NOT NULL", f"{d} >= {a}",
                     rule_id=rule_id)


def one(name, rule, source_table, sql, frame=None):
    """Registers a query that evaluates a single rule on a driver table or frame."""
    def run(spark, sf_dir):
        df = frame(spark, sf_dir) if frame else table(spark, sf_dir, source_table)
        return r.evaluate(df, [rule], source_table).select(*COLUMNS)

    query(name, sql)(run)


# --- rules ----------------------------------------------------------------------------------

def labelled(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(
        table(spark, sf_dir, "labels"), "doc_id", "left")


LABELLED = "(SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l USING (doc_id))"

_rule = r.completeness("quality", 0.3)
one("rule_completeness", _rule, "labelled",
    share_sql(_rule, LABELLED, "true", "quality IS NOT NULL", 0.3), labelled)
_rule = r.is_complete("o_orderpriority")
one("rule_is_complete", _rule, "orders",
    share_sql(_rule, "orders", "true", filled("o_orderpriority"), 1.0))
_rule = r.value_range("l_quantity", 1, 45)
one("rule_range", _rule, "lineitem",
    share_sql(_rule, "lineitem", "l_quantity IS NOT NULL", "l_quantity BETWEEN 1 AND 45"))
_rule = r.value_range("quality", 0, 1, null_policy="fail")
one("rule_range_null_fails", _rule, "labelled",
    share_sql(_rule, LABELLED, "true", "quality IS NOT NULL AND quality BETWEEN 0 AND 1"), labelled)
_rule = r.value_range("o_totalprice", 5000, 495000, threshold=0.95)
one("rule_range_threshold", _rule, "orders",
    share_sql(_rule, "orders", "o_totalprice IS NOT NULL",
              "o_totalprice BETWEEN 5000 AND 495000", 0.95))
_rule = r.minimum("c_acctbal", 0)
one("rule_min", _rule, "customer",
    share_sql(_rule, "customer", "c_acctbal IS NOT NULL", "c_acctbal >= 0"))
_rule = r.unique("o_orderkey")
one("rule_uniqueness", _rule, "orders", unique_sql(_rule, "orders", ["o_orderkey"]))
_rule = r.unique("l_orderkey", "l_linenumber")
one("rule_uniqueness_pair", _rule, "lineitem",
    unique_sql(_rule, "lineitem", ["l_orderkey", "l_linenumber"]))
_rule = r.date_order("admission_date", "discharge_date")
one("rule_date_order", _rule, "records", with_ctes("rec", dates_sql(_rule, "rec")),
    derived.records)
_rule = r.pattern("url", r"https://[^/]+/en/\d+", 0.2)
one("rule_regex", _rule, "pages",
    share_sql(_rule, "pages", "url <> ''", r"regexp_matches(url, '^https://[^/]+/en/\d+')", 0.2))
_rule = r.icd10("primary_icd10")
one("rule_icd10", _rule, "flat", with_ctes("rec flat", share_sql(
    _rule, "flat", "primary_icd10 <> ''",
    rf"regexp_matches(primary_icd10, '{fv.ICD10_RULE_PATTERN}')", 0.90)),
    lambda s, d: rec_ops.flatten(derived.records(s, d)))
_rule = r.values_in("o_orderstatus", ["F", "O"])
one("rule_values_in", _rule, "orders", share_sql(
    _rule, "orders", "o_orderstatus IS NOT NULL", "o_orderstatus IN ('F', 'O')"))
_rule = r.length_min("text", 200)
one("rule_length_min", _rule, "documents",
    share_sql(_rule, "documents", "text <> ''", "length(text) >= 200"))
_rule = r.length_between("text", 100, 20000, 0.9)
one("rule_length_between", _rule, "documents", share_sql(
    _rule, "documents", "text <> ''", "length(text) BETWEEN 100 AND 20000", 0.9))
_rule = r.array_not_empty("diagnoses", 10)
one("rule_array_not_empty", _rule, "records", with_ctes("rec", count_sql(
    _rule, "rec", "len(diagnoses) = 0", 10, "count(diagnoses)")), derived.records)
_rule = r.null_count("medications", 20)
one("rule_null_count", _rule, "records",
    with_ctes("rec", count_sql(_rule, "rec", "medications IS NULL", 20)), derived.records)
_rule = r.nested_range("vitals_at_discharge.systolic_bp", 50, 250)
_V = "vitals_at_discharge.systolic_bp"
one("rule_nested_range", _rule, "records", with_ctes("rec", share_sql(
    _rule, "rec", f"{_V} IS NOT NULL", f"{_V} BETWEEN 50 AND 250")), derived.records)
_rule = r.mean_between("l_quantity", 20, 30)
one("rule_mean", _rule, "lineitem",
    stat_sql(_rule, "lineitem", "l_quantity", "avg(l_quantity)", "{v} BETWEEN 20 AND 30"))
_rule = r.stddev_max("l_quantity", 14.0)
one("rule_stddev", _rule, "lineitem",
    stat_sql(_rule, "lineitem", "l_quantity", "stddev_samp(l_quantity)", "{v} <= 14.0"))
_rule = r.stddev_between("o_totalprice", 100000, 200000)
one("rule_stddev_between", _rule, "orders",
    stat_sql(_rule, "orders", "o_totalprice", "stddev_samp(o_totalprice)",
             "{v} BETWEEN 100000 AND 200000"))
_rule = r.custom_sql("SELECT COUNT(*) FROM primary WHERE l_discount > 0.05 AND l_tax = 0",
                     "<=", 100)
one("rule_custom_sql", _rule, "lineitem", rule_sql(
    _rule, "lineitem WHERE l_discount > 0.05 AND l_tax = 0", "count(*) <= 100", _NULL,
    metric="count(*)", total=_NULL))
_rule = r.where_count("size(medications) = 0 OR vitals_at_discharge.heart_rate < 0", 10)
one("rule_where_count", _rule, "records", with_ctes("rec", count_sql(
    _rule, "rec", "len(medications) = 0 OR vitals_at_discharge.heart_rate < 0", 10)),
    derived.records)

_counts = [r.row_count(least=1000), r.row_count(equal=15000), r.row_count(10, 20000)]


@query("rule_row_count", " UNION ALL ".join(
    rows_sql(rule, "orders", test, i) for i, (rule, test) in enumerate(
        zip(_counts, [">= 1000", "= 15000", "BETWEEN 10 AND 20000"]), 1)))
def _(spark, sf_dir):
    return r.evaluate(table(spark, sf_dir, "orders"), _counts, "orders").select(*COLUMNS)


@query("rule_error_outcome", """
SELECT CAST(1 AS BIGINT) AS rule_id, 'ERROR' AS outcome UNION ALL SELECT 2, 'ERROR'
UNION ALL SELECT 3, CASE WHEN count(*) >= 1 THEN 'PASS' ELSE 'FAIL' END FROM orders""")
def _(spark, sf_dir):
    broken = [r.completeness("no_such_column", 1.0), r.mean_between("o_orderstatus", 0, 1),
              r.row_count(least=1)]
    return r.evaluate(table(spark, sf_dir, "orders"), broken, "orders").select(
        "rule_id", "outcome")


# --- violations ------------------------------------------------------------------------------

_order_rules = [r.value_range("o_totalprice", 10000, 490000),
                r.values_in("o_orderstatus", ["F", "O"]),
                r.completeness("o_orderpriority", 1.0)]
_VIOLATIONS = """
SELECT CAST(rule_id AS BIGINT) AS rule_id, CAST(k AS VARCHAR) AS record_id, value,
  CAST(rank AS BIGINT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY k, value) AS rank FROM (
    SELECT 1 AS rule_id, o_orderkey AS k, CAST(o_totalprice AS VARCHAR) AS value FROM orders
      WHERE o_totalprice < 10000 OR o_totalprice > 490000
    UNION ALL SELECT 2, o_orderkey, o_orderstatus FROM orders
      WHERE o_orderstatus NOT IN ('F', 'O')
    UNION ALL SELECT 3, o_orderkey, o_orderpriority FROM orders
      WHERE o_orderpriority IS NULL OR o_orderpriority IN ('', 'None')))
WHERE rank <= """


@query("rule_violations", _VIOLATIONS + "10")
def _(spark, sf_dir):
    return r.violations(table(spark, sf_dir, "orders"), _order_rules, "orders",
                        "o_orderkey").drop("table_name")


@query("topk_violations", _VIOLATIONS + "3")
def _(spark, sf_dir):
    return r.violations(table(spark, sf_dir, "orders"), _order_rules, "orders", "o_orderkey",
                        keep=3).drop("table_name")


# --- rule sets -------------------------------------------------------------------------------

def _shares(rules, cols, source, start):
    return [share_sql(rule, source, "true", filled(col), threshold, start + i)
            for i, (rule, (col, threshold)) in enumerate(zip(rules, cols))]


def _range(rule, source, col, low, high, i):
    return share_sql(rule, source, f"{col} IS NOT NULL", f"{col} BETWEEN {low} AND {high}",
                     rule_id=i)


def _record_stats(rules, source, start):
    return [
        stat_sql(rules[0], source, "age", "avg(age)", "{v} BETWEEN 40 AND 80", start),
        stat_sql(rules[1], source, "length_of_stay_days", "stddev_samp(length_of_stay_days)",
                 "{v} <= 15", start + 1),
        rows_sql(rules[2], source, ">= 100", start + 2)]


def flat_sql():
    q = rulesets.flat_records()
    cols = [("patient_name", 0.98), ("mrn", 1.0), ("admission_date", 1.0),
            ("discharge_date", 1.0), ("primary_icd10", 0.95), ("systolic_bp", 0.90),
            ("diastolic_bp", 0.90)]
    bounds = [("age", 0, 120), ("systolic_bp", 50, 250), ("diastolic_bp", 30, 150),
              ("heart_rate", 20, 250), ("temperature_f", 90.0, 108.0),
              ("length_of_stay_days", 0, 100)]
    return (_shares(q, cols, "flat", 1)
            + [unique_sql(q[7], "flat", ["record_id"], 8), dates_sql(q[8], "flat", 9)]
            + [_range(q[9 + i], "flat", *b, 10 + i) for i, b in enumerate(bounds)]
            + [share_sql(q[15], "flat", "primary_icd10 <> ''",
                         rf"regexp_matches(primary_icd10, '{fv.ICD10_RULE_PATTERN}')", 0.90, 16)]
            + _record_stats(q[16:], "flat", 17))


def nested_sql():
    q = rulesets.nested_records()
    cols = [("patient_name", 0.98), ("mrn", 1.0), ("record_id", 1.0), ("admission_date", 1.0),
            ("discharge_date", 1.0), ("attending_physician", 1.0), ("department", 1.0)]
    v = "vitals_at_discharge."
    return (_shares(q, cols, "rec", 1)
            + [count_sql(q[7 + i], "rec", f"{c} IS NULL", n, rule_id=8 + i) for i, (c, n) in
               enumerate([("diagnoses", 10), ("medications", 20), ("vitals_at_discharge", 20)])]
            + [unique_sql(q[10], "rec", ["record_id"], 11),
               _range(q[11], "rec", "age", 0, 120, 12),
               _range(q[12], "rec", "length_of_stay_days", 0, 100, 13),
               share_sql(q[13], "rec", "gender IS NOT NULL", "gender IN ('M', 'F')", rule_id=14),
               dates_sql(q[14], "rec", 15),
               count_sql(q[15], "rec", "len(diagnoses) = 0", 0, "count(diagnoses)", 16),
               count_sql(q[16], "rec", "len(medications) = 0", 10, "count(medications)", 17),
               _range(q[17], "rec", f"{v}systolic_bp", 50, 250, 18),
               _range(q[18], "rec", f"{v}heart_rate", 0, 250, 19),
               _range(q[19], "rec", f"{v}temperature_f", 90.0, 108.0, 20)]
            + _record_stats(q[20:], "rec", 21))


def notes_sql():
    q = rulesets.notes()
    cols = [(c, 1.0) for c in ("note_text", "record_id", "mrn", "note_type", "author", "date")]
    patterns = [("date", fv.NOTE_DATE_PATTERN, 0.95), ("mrn", fv.MRN_PATTERN, 0.95),
                ("author", fv.AUTHOR_PATTERN, 0.90)]
    return (_shares(q, cols, "nts", 1)
            + [unique_sql(q[6], "nts", ["record_id"], 7),
               share_sql(q[7], "nts", "note_type IS NOT NULL",
                         f"note_type IN ({derived.listed(fv.NOTE_TYPES)[1:-1]})", rule_id=8),
               share_sql(q[8], "nts", "note_text <> ''", "length(note_text) >= 20", rule_id=9)]
            + [share_sql(q[9 + i], "nts", f"{c} <> ''", f"regexp_matches({c}, '{p}')", t, 10 + i)
               for i, (c, p, t) in enumerate(patterns)]
            + [rows_sql(q[12], "nts", ">= 100", 13), rows_sql(q[13], "nts", "= 200", 14)])


def _sets(spark, sf_dir, frames=None):
    rec, nts = frames or (derived.records(spark, sf_dir), derived.notes(spark, sf_dir))
    return {
        "patient_records_csv": (rec_ops.flatten(rec), rulesets.flat_records()),
        "patient_records_json": (rec, rulesets.nested_records()),
        "clinical_notes_json": (nts, rulesets.notes()),
    }


def _results(spark, sf_dir, *names, frames=None):
    out = None
    for name, (df, ruleset) in _sets(spark, sf_dir, frames).items():
        if not names or name in names:
            one_set = r.evaluate(df, ruleset, name, "run-1")
            out = one_set if out is None else out.unionByName(one_set)
    return out


@query("ruleset_flat", with_ctes("rec flat", " UNION ALL ".join(flat_sql())))
def _(spark, sf_dir):
    return _results(spark, sf_dir, "patient_records_csv").select(*COLUMNS)


@query("ruleset_ledger", with_ctes("rec flat", " UNION ALL ".join(flat_sql())))
def _(spark, sf_dir):
    """Three files of records, the last of which comes after a first run: the second run reads
    that one alone, and a third none at all."""
    path, folder = fresh_path(spark, "ledger-table"), fresh_path(spark, "ledger")
    flat, rules = rec_ops.flatten(derived.records(spark, sf_dir)), rulesets.flat_records()
    for run, parts in (("run-1", "0, 1"), ("run-2", "2"), ("run-3", None)):
        if parts:
            flat.where(f"pmod(record_id, 3) IN ({parts})").write.mode("append").parquet(path)
        found = ledger.evaluate(spark, path, rules, "patient_records_csv", folder, run)
    return found.select(*COLUMNS)


@query("ruleset_nested", with_ctes("rec", " UNION ALL ".join(nested_sql())))
def _(spark, sf_dir):
    return _results(spark, sf_dir, "patient_records_json").select(*COLUMNS)


@query("ruleset_text", with_ctes("nts", " UNION ALL ".join(notes_sql())))
def _(spark, sf_dir):
    return _results(spark, sf_dir, "clinical_notes_json").select(*COLUMNS)


RESULTS_SQL = (
    f"SELECT 'patient_records_csv' AS table_name, * FROM ({' UNION ALL '.join(flat_sql())}) "
    "UNION ALL SELECT 'patient_records_json' AS table_name, * FROM "
    f"({' UNION ALL '.join(nested_sql())}) UNION ALL SELECT 'clinical_notes_json' AS table_name, "
    f"* FROM ({' UNION ALL '.join(notes_sql())})")
_PASSED = "count(*) FILTER (outcome = 'PASS')"
_SCORE = f"round({_PASSED} * 100.0::DOUBLE / count(*), 1)"


def over_results(body: str, **more: str) -> str:
    return with_ctes("rec nts flat", body, res=RESULTS_SQL, **more)


@query("union_reports", over_results(
    "SELECT table_name, rule_id, rule, outcome FROM res"))
def _(spark, sf_dir):
    return _results(spark, sf_dir).select("table_name", "rule_id", "rule", "outcome")


SCORES_SQL = (f"SELECT table_name, count(*) AS total_rules, {_PASSED} AS rules_passed, "
              f"count(*) - {_PASSED} AS rules_failed, {_SCORE} AS overall_score, "
              "coalesce(max(total), 0) AS total_records FROM res GROUP BY table_name")


@query("dq_score", over_results(SCORES_SQL))
def _(spark, sf_dir):
    return r.score(_results(spark, sf_dir)).drop("run_id")


@query("dq_score_all", over_results(
    f"SELECT table_name, count(*) AS total_rules, {_PASSED} AS rules_passed, "
    f"count(*) - {_PASSED} AS rules_failed, {_SCORE} AS overall_score "
    "FROM res GROUP BY ROLLUP (table_name)"))
def _(spark, sf_dir):
    return r.score_all(_results(spark, sf_dir))


@query("dq_outcome_counts", over_results(
    "SELECT 'run-1' AS run_id, outcome, count(*) AS rules FROM res GROUP BY outcome"))
def _(spark, sf_dir):
    return r.outcome_counts(_results(spark, sf_dir))


@query("score_from_counts", over_results(
    f"SELECT table_name, round({_PASSED}::DOUBLE / count(*), 6) AS score FROM res "
    "GROUP BY table_name"))
def _(spark, sf_dir):
    scored = r.score_from_counts(r.score(_results(spark, sf_dir)), "rules_passed",
                                 "rules_failed")
    return scored.select("table_name", F.round("score", 6).alias("score"))


# --- cross-table dates -----------------------------------------------------------------------

@query("cross_table_consistency", """
SELECT count(*) AS checked, count(*) FILTER (l_shipdate < o_orderdate) AS violations,
  count(*) FILTER (l_shipdate < o_orderdate) = 0 AS passed
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return cross_table_dates(lines, orders, F.col("l_orderkey") == F.col("o_orderkey"),
                             "o_orderdate", "l_shipdate")


# --- analyzers -------------------------------------------------------------------------------

def _analyzer(name, source, chosen, sql):
    def run(spark, sf_dir):
        return an.analyze(table(spark, sf_dir, source), chosen, source).select(
            "metric", F.round("value", 6).alias("value"))

    query(name, sql)(run)


def metric_sql(metric, value, source):
    return f"SELECT '{metric}' AS metric, round(CAST({value} AS DOUBLE), 6) AS value FROM {source}"


_analyzer("an_row_count", "lineitem", [an.Analyzer("row_count")],
          metric_sql("Dataset.*.RowCount", "count(*)", "lineitem"))
_analyzer("an_completeness", "documents", [an.Analyzer("completeness", "lang")],
          metric_sql("Column.lang.Completeness",
                     f"count(*) FILTER {filled('lang')} / count(*)::DOUBLE", "documents"))
_analyzer("an_column_length", "documents", [an.Analyzer("length", "text")], " UNION ALL ".join(
    metric_sql(f"Column.text.{n}Length", f"{f}(length(text))", "documents")
    for n, f in [("Minimum", "min"), ("Maximum", "max"), ("Average", "avg")]))
_analyzer("an_distinct_count", "orders", [an.Analyzer("distinct", "o_orderpriority"),
                                          an.Analyzer("distinct", "o_custkey")],
          " UNION ALL ".join(metric_sql(f"Column.{c}.DistinctValuesCount",
                                        f"count(DISTINCT {c})", "orders")
                             for c in ("o_orderpriority", "o_custkey")))
_analyzer("an_mean", "lineitem", [an.Analyzer("mean", "l_quantity")],
          metric_sql("Column.l_quantity.Mean", "avg(l_quantity)", "lineitem"))
_analyzer("an_stddev", "lineitem", [an.Analyzer("stddev", "l_quantity")],
          metric_sql("Column.l_quantity.StandardDeviation", "stddev_samp(l_quantity)",
                     "lineitem"))

_RUN = [an.Analyzer("row_count"), an.Analyzer("completeness", "o_orderpriority"),
        an.Analyzer("length", "o_orderpriority"), an.Analyzer("distinct", "o_orderstatus"),
        an.Analyzer("mean", "o_totalprice"), an.Analyzer("stddev", "o_totalprice")]


@query("analyzer_run", " UNION ALL ".join(
    f"SELECT 'orders' AS table_name, 'run-1' AS run_id, * FROM ({s})" for s in [
        metric_sql("Dataset.*.RowCount", "count(*)", "orders"),
        metric_sql("Column.o_orderpriority.Completeness",
                   f"count(*) FILTER {filled('o_orderpriority')} / count(*)::DOUBLE", "orders"),
        *[metric_sql(f"Column.o_orderpriority.{n}Length", f"{f}(length(o_orderpriority))",
                     "orders") for n, f in [("Minimum", "min"), ("Maximum", "max"),
                                            ("Average", "avg")]],
        metric_sql("Column.o_orderstatus.DistinctValuesCount", "count(DISTINCT o_orderstatus)",
                   "orders"),
        metric_sql("Column.o_totalprice.Mean", "avg(o_totalprice)", "orders"),
        metric_sql("Column.o_totalprice.StandardDeviation", "stddev_samp(o_totalprice)",
                   "orders")]))
def _(spark, sf_dir):
    return an.analyze(table(spark, sf_dir, "orders"), _RUN, "orders", "run-1").select(
        "table_name", "run_id", "metric", F.round("value", 6).alias("value"))


_MERGED = ["o_orderstatus", "o_orderpriority", "o_totalprice"]


@query("analyzer_states", " UNION ALL ".join(
    [metric_sql("Dataset.*.RowCount", "count(*)", "orders")]
    + [metric_sql(f"Column.{c}.Completeness", f"count(*) FILTER {filled(c)} / count(*)::DOUBLE",
                  "orders") for c in _MERGED]
    + [metric_sql(f"Column.{c}.{n}Length", f"{f}(length({c}))", "orders") for c in _MERGED[:2]
       for n, f in [("Minimum", "min"), ("Maximum", "max"), ("Average", "avg")]]
    + [metric_sql(f"Column.{c}.DistinctValuesCount", f"count(DISTINCT {c})", "orders")
       for c in _MERGED[:2]]
    + [metric_sql("Column.o_totalprice.Mean", "avg(o_totalprice)", "orders"),
       metric_sql("Column.o_totalprice.StandardDeviation", "stddev_samp(o_totalprice)",
                  "orders")]))
def _(spark, sf_dir):
    """States of seven parts, merged. The sketch counts a few values exactly; that of prices is
    an estimate and isn't shown."""
    orders = table(spark, sf_dir, "orders").select(
        *_MERGED, (F.col("o_orderkey") % 7).alias("part"))
    parts = settle(states.states(orders, ["part"]), "states")
    found = states.metrics_of(states.merge(parts.drop("part")))
    return found.where("metric != 'Column.o_totalprice.DistinctValuesCount'").select(
        "metric", F.round("value", 6).alias("value"))


# --- recommendation --------------------------------------------------------------------------

def _recommended_sql(source, columns):
    parts = []
    for name, kind in columns:
        head = f"SELECT '{name}' AS \"column\", "
        parts.append(f"{head}'Completeness' AS type, 'IsComplete \"{name}\"' AS rule FROM "
                     f"{source} HAVING count(*) FILTER (NOT {filled(name)}) = 0")
        if kind in ("whole", "real"):
            low, high = (f"CAST({f}({name}) AS VARCHAR)" for f in ("min", "max"))
            parts.append(f"{head}'Range' AS type, 'ColumnValues \"{name}\" between ' || {low} || "
                         f"' and ' || {high} || ' with threshold >= 0.95' AS rule FROM {source}")
            sd = f"stddev_samp({name})"
            parts.append(f"{head}'Statistical' AS type, 'StandardDeviation \"{name}\" between ' "
                         f"|| printf('%.2f', {sd} * 0.75) || ' and ' || "
                         f"printf('%.2f', {sd} * 1.25) AS rule FROM {source}")
        else:
            parts.append(f"{head}'ColumnLength' AS type, 'ColumnLength \"{name}\" between ' || "
                         f"min(length({name})) || ' and ' || max(length({name})) || "
                         f"' with threshold >= 0.99' AS rule FROM {source}")
            parts.append(
                f"{head}'ValueSet' AS type, 'ColumnValues \"{name}\" in [' || "
                f"string_agg('\"' || v || '\"', ', ' ORDER BY v) || ']' AS rule FROM "
                f"(SELECT DISTINCT {name} AS v FROM {source} WHERE {name} IS NOT NULL) "
                f"HAVING count(*) <= {an.VALUE_SET_SIZE}")
    parts.append("SELECT NULL AS \"column\", 'RowCount' AS type, 'RowCount between ' || "
                 "CAST(floor(count(*) * 0.5) AS BIGINT) || ' and ' || "
                 f"CAST(ceil(count(*) * 1.5) AS BIGINT) AS rule FROM {source}")
    return " UNION ALL ".join(parts)


PART_SQL = _recommended_sql("part", [("p_partkey", "whole"), ("p_name", "text"),
                                     ("p_brand", "text"), ("p_type", "text"), ("p_size", "whole"),
                                     ("p_retailprice", "real")])


@query("recommend_rules", PART_SQL)
def _(spark, sf_dir):
    return an.recommend(table(spark, sf_dir, "part"))


_WRITTEN = [r.is_complete("p_brand"), r.is_complete("p_partkey"),
            r.value_range("p_size", 1, 50, threshold=0.95), r.value_range("p_size", 1, 60),
            r.row_count(least=100)]


@query("rules_diff", f"""
WITH a AS (SELECT DISTINCT rule FROM ({PART_SQL})), b AS (SELECT * FROM (VALUES
  {', '.join(f'({quoted(x.text)})' for x in _WRITTEN)}) t(rule))
SELECT coalesce(a.rule, b.rule) AS rule,
  CASE WHEN a.rule IS NULL THEN 'written' WHEN b.rule IS NULL THEN 'recommended'
    ELSE 'both' END AS side
FROM a FULL JOIN b ON a.rule = b.rule""")
def _(spark, sf_dir):
    written = spark.createDataFrame([(x.text,) for x in _WRITTEN], "rule string")
    return an.rules_diff(an.recommend(table(spark, sf_dir, "part")), written)


# --- run history -----------------------------------------------------------------------------

def monthly_runs(spark, sf_dir):
    """Two metrics of orders for each month and status, taken as the runs of a table."""
    month = F.date_trunc("month", F.col("o_orderdate").cast("timestamp"))
    runs = (table(spark, sf_dir, "orders")
            .groupBy(F.concat(F.lit("orders_"), "o_orderstatus").alias("table_name"),
                     month.alias("run_ts"))
            .agg(F.count("*").cast("double").alias("n"), F.avg("o_totalprice").alias("mean"),
                 F.when(F.max("o_orderkey") % 19 == 0, 98.7).otherwise(98.6).alias("fixed")))
    return runs.select("table_name", F.date_format("run_ts", "yyyy-MM").alias("run_id"), "run_ts",
                       F.inline(F.array(
                           F.struct(F.lit("Dataset.*.RowCount").alias("metric"),
                                    F.col("n").alias("value")),
                           F.struct(F.lit("Column.o_totalprice.Mean").alias("metric"),
                                    F.col("mean").alias("value")),
                           F.struct(F.lit("Dataset.*.Fixed").alias("metric"),
                                    F.col("fixed").alias("value")))))


_MONTHLY = """
SELECT 'orders_' || o_orderstatus AS table_name, strftime(date_trunc('month', o_orderdate), '%Y-%m')
  AS run_id, 'Dataset.*.RowCount' AS metric, count(*)::DOUBLE AS value FROM orders GROUP BY ALL
UNION ALL SELECT 'orders_' || o_orderstatus, strftime(date_trunc('month', o_orderdate), '%Y-%m'),
  'Column.o_totalprice.Mean', avg(o_totalprice) FROM orders GROUP BY ALL
UNION ALL SELECT 'orders_' || o_orderstatus, strftime(date_trunc('month', o_orderdate), '%Y-%m'),
  'Dataset.*.Fixed', CASE WHEN max(o_orderkey) % 19 = 0 THEN 98.7 ELSE 98.6 END::DOUBLE
  FROM orders GROUP BY ALL
"""


OBSERVED_SQL = f"""h AS ({_MONTHLY}), w AS (SELECT *,
  CASE WHEN min(value) OVER p = max(value) OVER p THEN min(value) OVER p
    ELSE avg(value) OVER p END AS expected,
  CASE WHEN min(value) OVER p = max(value) OVER p THEN 0
    ELSE 1.5 * stddev_samp(value) OVER p END AS spread, count(value) OVER p AS runs FROM h
  WINDOW p AS (PARTITION BY table_name, metric ORDER BY run_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
seen AS (SELECT * FROM w
  WHERE runs >= 5 AND NOT (value BETWEEN expected - spread AND expected + spread))"""


@query("anomaly_observations", f"""
WITH {OBSERVED_SQL} SELECT table_name, run_id, metric, round(value, 2) AS actual, round(expected, 2) AS expected,
  round(expected - spread, 2) AS lower, round(expected + spread, 2) AS upper FROM seen""")
def _(spark, sf_dir):
    seen = an.observations(monthly_runs(spark, sf_dir), width=1.5)
    return seen.select("table_name", "run_id", "metric",
                       *[F.round(c, 2).alias(c) for c in ("actual", "expected", "lower", "upper")])


_YEARLY = """SELECT 'orders' AS table_name, strftime(o_orderdate, '%Y') AS run_id,
  'Count.' || o_orderstatus AS metric, count(*)::DOUBLE AS value FROM orders GROUP BY ALL
UNION ALL SELECT 'orders', strftime(o_orderdate, '%Y'), 'Mean.' || o_orderstatus, avg(o_totalprice)
  FROM orders GROUP BY ALL"""


@query("anomaly_running", f"""
WITH {OBSERVED_SQL.replace(_MONTHLY, _YEARLY).replace('runs >= 5', 'runs >= 3')}
SELECT run_id, metric, round(value, 2) AS actual, round(expected, 2) AS expected,
  round(expected - spread, 2) AS lower, round(expected + spread, 2) AS upper FROM seen""")
def _(spark, sf_dir):
    """A run per year; each reads its own metrics and one row of history per metric."""
    year = F.date_trunc("year", F.col("o_orderdate").cast("timestamp"))
    runs = settle(table(spark, sf_dir, "orders").groupBy("o_orderstatus", year.alias("run_ts")).agg(
        F.count("*").cast("double").alias("n"), F.avg("o_totalprice").alias("mean")).select(
        F.lit("orders").alias("table_name"), F.date_format("run_ts", "yyyy").alias("run_id"),
        "run_ts", F.inline(F.array(*[F.struct(F.concat(F.lit(f"{k}."), "o_orderstatus").alias("metric"),
                                              F.col(c).alias("value"))
                                     for k, c in (("Count", "n"), ("Mean", "mean"))]))), "runs")
    history, out = states.no_history(spark), None
    for row in runs.select("run_id").distinct().orderBy("run_id").collect():
        seen, history = states.observe(history, runs.where(F.col("run_id") == row[0]), 1.5, 3)
        history = settle(history, "history")
        out = seen if out is None else out.unionByName(seen)
    if out is None:
        out = an.observations(runs)
    return out.select("run_id", "metric",
                      *[F.round(c, 2).alias(c) for c in ("actual", "expected", "lower", "upper")])


def _scores(spark, sf_dir):
    """The share of high-value orders per status and month, as a score history."""
    month = F.date_trunc("month", F.col("o_orderdate").cast("timestamp"))
    return (table(spark, sf_dir, "orders")
            .groupBy(F.col("o_orderstatus").alias("table_name"), month.alias("run_ts"))
            .agg(F.round(F.count_if(F.col("o_totalprice") > 100000) * 100.0 / F.count("*"), 1)
                 .alias("score"))
            .withColumn("run_id", F.date_format("run_ts", "yyyy-MM")))


_SCORES = """
SELECT o_orderstatus AS table_name, strftime(date_trunc('month', o_orderdate), '%Y-%m') AS run_id,
  round(count(*) FILTER (o_totalprice > 100000) * 100.0::DOUBLE / count(*), 1) AS score
FROM orders GROUP BY ALL
"""


@query("latest_result", f"""
SELECT table_name, max(run_id) AS run_id, arg_max(score, run_id) AS score FROM ({_SCORES})
GROUP BY table_name""")
def _(spark, sf_dir):
    return an.latest_result(_scores(spark, sf_dir)).select("table_name", "run_id", "score")


@query("score_trend", f"""
SELECT table_name, run_id, score, lag(score) OVER w AS previous,
  round(score - lag(score) OVER w, 4) AS change FROM ({_SCORES})
WINDOW w AS (PARTITION BY table_name ORDER BY run_id)""")
def _(spark, sf_dir):
    return an.score_trend(_scores(spark, sf_dir)).select(
        "table_name", "run_id", "score", "previous", F.round("change", 4).alias("change"))


_GOVERNED = [r.value_range("o_totalprice", 0, 480000), r.unique("o_orderkey"),
             r.values_in("o_orderstatus", ["F", "O", "P"]), r.row_count(least=100)]


@query("governed_run", """
WITH k AS (SELECT unnest([0, 1, 2]) AS k), p AS (
  SELECT k, count(*) FILTER (o_totalprice NOT BETWEEN 0 AND 480000) = 0 AS a,
    count(*) = count(DISTINCT o_orderkey) AS b,
    count(*) FILTER (o_orderstatus NOT IN ('F', 'O', 'P')) = 0 AS c, count(*) >= 100 AS d
  FROM orders JOIN k ON o_orderkey % 3 <= k GROUP BY k),
n AS (SELECT k, a::BIGINT + b::BIGINT + c::BIGINT + d::BIGINT AS passed FROM p)
SELECT 'run-' || k AS run_id, passed AS rules_passed, CAST(4 AS BIGINT) AS total_rules,
  CASE WHEN passed >= 3.6 THEN 'pass' ELSE 'quarantine' END AS decision FROM n""")
def _(spark, sf_dir):
    """A table that grows by a third a run; each run is ruled, observed, decided and metered."""
    from . import jobs

    path, folder = fresh_path(spark, "governed-table"), fresh_path(spark, "governed")
    orders, out = table(spark, sf_dir, "orders"), None
    for k in range(3):
        orders.where(F.col("o_orderkey") % 3 == k).write.mode("append").parquet(path)
        one = jobs.governed_run(
            spark, path, _GOVERNED, "orders", folder, f"run-{k}", f"2024-01-0{k + 1} 00:00:00",
            watched=[an.Analyzer("mean", "o_totalprice")])
        out = one if out is None else out.unionByName(one)
    return out.select("run_id", "rules_passed", "total_rules", "decision")
