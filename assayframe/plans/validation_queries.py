"""Queries: record checks, levels, splits, routing, summaries, joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.predicates import missing, required_missing
from ..operators import joins, records as rec_ops, routing, rules as r, summaries, validation as v
from ..operators.analyzers import observations
from ..operators.issues import found, issue, unfold
from ..session import settle
from . import derived
from .derived import AS_OF, listed, quoted, with_ctes
from .registry import query, table
from .rule_queries import OBSERVED_SQL, day_sql, filled, monthly_runs

ISSUE_COLUMNS = ["record_id", "type", "field", "severity", "value", "message"]

# --- the checks in SQL ---------------------------------------------------------------------

_GAP = {"age": "age IS NULL", "diagnoses": "diagnoses IS NULL OR len(diagnoses) = 0"}


def issue_sql(kind, field, severity, value, message, source, where="true"):
    field = "CAST(NULL AS VARCHAR)" if field is None else f"'{field}'"
    severity = f"'{severity}'" if severity in ("ERROR", "WARNING") else severity
    return (f"SELECT record_id, '{kind}' AS type, {field} AS field, {severity} AS severity, "
            f"{value} AS value, {message} AS message FROM {source} WHERE {where}")


NONE = "CAST(NULL AS VARCHAR)"
MISSING_SQL = " UNION ALL ".join(
    issue_sql("MISSING_REQUIRED_FIELD", f, "ERROR", NONE,
              quoted(f"Required field '{f}' is missing or empty"), "rec",
              _GAP.get(f, f"{f} IS NULL OR {f} = ''"))
    for f in fv.REQUIRED_FIELDS)
AGE_SQL = issue_sql("INVALID_AGE", "age", "ERROR", "CAST(age AS VARCHAR)",
                    "'Age ' || age || ' is outside valid range [0, 120]'", "rec",
                    "age < 0 OR age > 120")
GENDER_SQL = issue_sql("INVALID_GENDER", "gender", "WARNING", "gender",
                       "'Gender ''' || gender || ''' not in standard set (M/F/O/U)'", "rec",
                       "gender NOT IN ('M', 'F', 'O', 'U', '')")
DAYS = (f"(SELECT *, {day_sql('admission_date')} AS a, {day_sql('discharge_date')} AS d FROM rec)")
DATE_SQLS = {
    "DATE_INCONSISTENCY": issue_sql(
        "DATE_INCONSISTENCY", "discharge_date", "ERROR", NONE,
        "'Discharge date (' || discharge_date || ') before admission date (' || admission_date "
        "|| ')'", DAYS, "d < a"),
    "FUTURE_DATE": issue_sql(
        "FUTURE_DATE", "discharge_date", "ERROR", NONE,
        "'Discharge date (' || discharge_date || ') is in the future'", DAYS,
        f"a IS NOT NULL AND CAST(d AS TIMESTAMP) > TIMESTAMP '{AS_OF}'"),
    "LOS_MISMATCH": issue_sql(
        "LOS_MISMATCH", "length_of_stay_days", "WARNING", NONE,
        "'Stated LOS (' || length_of_stay_days || ') doesn''t match computed (' || (d - a) || ')'",
        DAYS, "abs((d - a) - length_of_stay_days) > 1"),
    "INVALID_DATE_FORMAT": issue_sql(
        "INVALID_DATE_FORMAT", None, "ERROR", NONE,
        "'Could not parse admission or discharge date (expected YYYY-MM-DD)'", DAYS,
        "a IS NULL OR d IS NULL"),
}
DX = "(SELECT record_id, unnest(diagnoses).icd10 AS code FROM rec)"
CODE_SQL = issue_sql(
    "INVALID_ICD10", "diagnoses.icd10", "ERROR", "code",
    "'ICD-10 code ''' || code || ''' does not match expected format'", DX,
    rf"code <> '' AND NOT regexp_matches(code, '{fv.ICD10_RECORD_PATTERN}')")


def vital_sqls(name, low, high, low_c, high_c, source="rec"):
    x = f"CAST(vitals_at_discharge.{name} AS DOUBLE)"
    shown = f"CAST({x} AS VARCHAR)"
    out = f"({x} < {low} OR {x} > {high})"
    return (issue_sql("VITAL_OUT_OF_RANGE", f"vitals.{name}", "ERROR", shown,
                      f"'{name}=' || {shown} || ' outside physiological range [{low}, {high}]'",
                      source, out),
            issue_sql("VITAL_CRITICAL", f"vitals.{name}", "WARNING", shown,
                      f"'{name}=' || {shown} || ' is in critical range'", source,
                      f"NOT {out} AND ({x} <= {low_c} OR {x} >= {high_c})"))


RANGE_SQL = " UNION ALL ".join(vital_sqls(*row)[0] for row in fv.VITAL_RANGES)
CRITICAL_SQL = " UNION ALL ".join(vital_sqls(*row)[1] for row in fv.VITAL_RANGES)
NAMES = "list_transform(medications, lambda m: m.name)"
INTERACTION_SQL = " UNION ALL ".join(
    issue_sql("DRUG_INTERACTION", "medications", "ERROR" if sev == "HIGH" else "WARNING", NONE,
              quoted(f"Drug interaction ({sev}): {' + '.join(sorted((a, b)))} — {text}"), "rec",
              f"list_contains({NAMES}, '{a}') AND list_contains({NAMES}, '{b}')")
    for a, b, sev, text in fv.DRUG_INTERACTIONS)
NOTE_SQL = issue_sql("MISSING_CLINICAL_NOTE", "clinical_note", "WARNING", NONE,
                     "'No clinical note attached to record'", "rec",
                     "coalesce(clinical_note, '') = ''")
RX = "(SELECT record_id, unnest(medications).dose AS dose FROM rec)"
DOSE_SQL = issue_sql("INVALID_DOSAGE_FORMAT", "medications.dose", "WARNING", "dose",
                     "'Dosage ''' || dose || ''' may not be in standard format'", RX,
                     f"dose <> '' AND NOT regexp_matches(dose, '(?i){fv.DOSE_PATTERN}')")

BASIC = [MISSING_SQL, AGE_SQL, GENDER_SQL, *DATE_SQLS.values()]
FULL = BASIC + [CODE_SQL, RANGE_SQL, CRITICAL_SQL, INTERACTION_SQL]
STRICT = FULL + [NOTE_SQL, DOSE_SQL]
LEVELS = {"basic": BASIC, "full": FULL, "strict": STRICT, "other": BASIC}


# --- one query per check -------------------------------------------------------------------

def _check(name, sql, checks, kinds=None, frame=derived.records):
    """``checks(df)`` gives issue Columns, or one Column of an issue array."""
    def run(spark, sf_dir):
        df = frame(spark, sf_dir)
        found = checks(df)
        found = F.concat(*found) if isinstance(found, list) else found
        out = df.select("record_id", unfold(found)).where("type is not null")
        if kinds:
            out = out.where(F.col("type").isin(kinds))
        return out.select(*ISSUE_COLUMNS)

    query(name, with_ctes("rec", sql))(run)


_check("v_missing_required", MISSING_SQL, v.missing_required)
_check("v_invalid_age", AGE_SQL, v.invalid_age)
_check("v_invalid_gender", GENDER_SQL, v.invalid_gender)
for _name, _kind in [("v_date_order", "DATE_INCONSISTENCY"), ("v_future_date", "FUTURE_DATE"),
                     ("v_los_mismatch", "LOS_MISMATCH"), ("v_bad_date", "INVALID_DATE_FORMAT")]:
    _check(_name, DATE_SQLS[_kind], lambda df: v.date_checks(df, AS_OF), [_kind])
_check("v_invalid_icd10", CODE_SQL, v.invalid_codes)
_check("v_vital_out_of_range", RANGE_SQL, v.vital_checks, ["VITAL_OUT_OF_RANGE"])
_check("v_vital_critical", CRITICAL_SQL, v.vital_checks, ["VITAL_CRITICAL"])
_check("v_drug_interaction", INTERACTION_SQL, v.interaction_issues)
_check("v_missing_note", NOTE_SQL, lambda df: [v.missing_note(df)])
_check("v_bad_dosage", DOSE_SQL, v.bad_doses)


def text_vitals(spark, sf_dir):
    """Records whose heart rate is text, now and then not a number."""
    rate = F.col("vitals_at_discharge.heart_rate").cast("string")
    return derived.records(spark, sf_dir).withColumn(
        "vitals_at_discharge", F.col("vitals_at_discharge").withField(
            "heart_rate", F.when(F.col("record_id") % 29 == 0, "n/a").otherwise(rate)))


_check("v_vital_not_numeric", issue_sql(
    "INVALID_VITAL_VALUE", "vitals.heart_rate", "ERROR", "'n/a'",
    "'Non-numeric vital sign value for heart_rate'", "rec",
    "record_id % 29 = 0 AND vitals_at_discharge IS NOT NULL"),
    v.vital_checks, ["INVALID_VITAL_VALUE"], text_vitals)


def generic_bands(df):
    return v.range_check(df, "p_size", "p_size", "p_size", 3, 45, 6, 40)


@query("v_range_critical", " UNION ALL ".join(
    vital_sqls("p_size", 3, 45, 6, 40,
               "(SELECT p_partkey AS record_id, {'p_size': p_size} AS vitals_at_discharge "
               "FROM part)")).replace("'vitals.p_size'", "'p_size'"))
def _(spark, sf_dir):
    df = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "record_id")
    return df.select("record_id", unfold(generic_bands(df))).where("type is not null").select(
        *ISSUE_COLUMNS)


# --- levels and status -----------------------------------------------------------------------

def status_sql(parts):
    """Per record: counts and status from the union of issue queries."""
    return (f"SELECT rec.record_id, count(*) FILTER (i.severity = 'ERROR') AS error_count, "
            "count(*) FILTER (i.severity = 'WARNING') AS warning_count, CASE WHEN "
            "count(*) FILTER (i.severity = 'ERROR') > 0 THEN 'FAIL' WHEN "
            "count(*) FILTER (i.severity = 'WARNING') > 0 THEN 'WARNING' ELSE 'PASS' END AS status "
            f"FROM rec LEFT JOIN ({' UNION ALL '.join(parts)}) i USING (record_id) "
            "GROUP BY rec.record_id")


_V = "_validation"


def _status(df):
    return df.select("record_id", f"{_V}.error_count", f"{_V}.warning_count", f"{_V}.status")


@query("v_status", with_ctes("rec", status_sql(FULL)))
def _(spark, sf_dir):
    return _status(v.validate(derived.records(spark, sf_dir), "full", AS_OF))


@query("v_level", with_ctes("rec", " UNION ALL ".join(
    f"SELECT '{level}' AS level, status, count(*) AS records, "
    f"CAST(sum(error_count) AS BIGINT) AS errors, CAST(sum(warning_count) AS BIGINT) AS warnings "
    f"FROM ({status_sql(parts)}) GROUP BY status" for level, parts in LEVELS.items())))
def _(spark, sf_dir):
    out = None
    for level in LEVELS:
        one = (_status(v.validate(derived.records(spark, sf_dir), level, AS_OF))
               .groupBy("status").agg(F.count("*").alias("records"),
                                      F.sum("error_count").alias("errors"),
                                      F.sum("warning_count").alias("warnings"))
               .withColumn("level", F.lit(level)))
        out = one if out is None else out.unionByName(one)
    return out


# --- projections and predicates ---------------------------------------------------------------

@query("flatten_record", with_ctes("rec flat", "SELECT * FROM flat"))
def _(spark, sf_dir):
    return rec_ops.flatten(derived.records(spark, sf_dir))


_ODD = ("SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'None' "
        "WHEN 3 THEN '  ' ELSE o_orderpriority END AS x FROM orders")


def _odd(spark, sf_dir):
    k = F.col("o_orderkey") % 7
    return table(spark, sf_dir, "orders").select("o_orderkey", F.when(k == 0, None).when(
        k == 1, "").when(k == 2, "None").when(k == 3, "  ").otherwise(
        F.col("o_orderpriority")).alias("x"))


@query("pred_missing", f"SELECT o_orderkey, NOT {filled('x')} AS missing FROM ({_ODD})")
def _(spark, sf_dir):
    df = _odd(spark, sf_dir)
    return df.select("o_orderkey", missing(F.col("x"), df.schema["x"].dataType).alias("missing"))


@query("pred_required_missing", with_ctes("rec", """
SELECT record_id, patient_name IS NULL OR patient_name = '' AS name_missing,
  diagnoses IS NULL OR len(diagnoses) = 0 AS diagnoses_missing, age IS NULL AS age_missing
FROM rec"""))
def _(spark, sf_dir):
    df = derived.records(spark, sf_dir)
    gap = {c: required_missing(F.col(c), df.schema[c].dataType)
           for c in ("patient_name", "diagnoses", "age")}
    return df.select("record_id", gap["patient_name"].alias("name_missing"),
                     gap["diagnoses"].alias("diagnoses_missing"), gap["age"].alias("age_missing"))


def validated_frame(spark, sf_dir):
    return v.validate(derived.records(spark, sf_dir), "full", AS_OF)


@query("attach_validation", with_ctes("rec", """
SELECT s.*, i.types FROM st s LEFT JOIN (SELECT record_id, string_agg(type || ':' ||
  coalesce(field, ''), ',' ORDER BY type, field) AS types FROM iss GROUP BY record_id) i
USING (record_id)""", iss=" UNION ALL ".join(FULL), st=status_sql(FULL)))
def _(spark, sf_dir):
    types = F.transform(F.array_sort(F.transform(
        F.col(f"{_V}.issues"), lambda i: F.struct(i["type"].alias("t"),
                                                  F.coalesce(i["field"], F.lit("")).alias("f")))),
        lambda x: F.concat(x["t"], F.lit(":"), x["f"]))
    return validated_frame(spark, sf_dir).select(
        "record_id", f"{_V}.error_count", f"{_V}.warning_count", f"{_V}.status",
        F.nullif(F.array_join(types, ","), F.lit("")).alias("types"))


@query("split_validated_flagged", with_ctes("rec", """
SELECT 'validated' AS side, record_id, status FROM st WHERE status IN ('PASS', 'WARNING')
UNION ALL SELECT 'flagged', record_id, status FROM st WHERE status IN ('WARNING', 'FAIL')""",
                                            st=status_sql(FULL)))
def _(spark, sf_dir):
    df = validated_frame(spark, sf_dir)
    kept = routing.validated(df).select(F.lit("validated").alias("side"), "record_id",
                                        f"{_V}.status")
    return kept.unionByName(routing.flagged(df).select(F.lit("flagged").alias("side"),
                                                       "record_id", "status"))


@query("strip_validation", with_ctes("rec", """
SELECT record_id, mrn, age, gender, len(medications) AS meds FROM rec JOIN st USING (record_id)
WHERE status <> 'FAIL'""", st=status_sql(FULL)))
def _(spark, sf_dir):
    return routing.strip_validation(validated_frame(spark, sf_dir)).select(
        "record_id", "mrn", "age", "gender", F.size("medications").alias("meds"))


_ROUTE = [r.value_range("o_totalprice", 10000, 490000), r.values_in("o_orderstatus", ["F", "O"]),
          r.completeness("o_orderpriority", 1.0)]


@query("route_rows", """
SELECT *, CASE WHEN violated = '' THEN 'processed' ELSE 'rejected' END AS route FROM (
  SELECT o_orderkey, concat_ws(',',
    CASE WHEN o_totalprice < 10000 OR o_totalprice > 490000 THEN '1' END,
    CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN '2' END,
    CASE WHEN o_orderpriority IS NULL OR o_orderpriority IN ('', 'None') THEN '3' END)
    AS violated FROM orders)""")
def _(spark, sf_dir):
    return routing.route_rows(table(spark, sf_dir, "orders"), _ROUTE).select(
        "o_orderkey", F.array_join(F.transform("violated", lambda t: t["rule_id"].cast("string")),
                                   ",").alias("violated"), "route")


#: Rules on the monthly metrics of orders: (metric, least, most).
_MONTH_RULES = [("Dataset.*.RowCount", 1, 10 ** 9), ("Column.o_totalprice.Mean", 0, 10 ** 6),
                ("Dataset.*.Fixed", 98, 99)]


@query("quality_gate", f"""
WITH {OBSERVED_SQL}, ob AS (SELECT table_name, run_id, count(*) AS n FROM seen GROUP BY ALL),
ok AS (SELECT table_name, run_id, count(*) AS total_rules, count(*) FILTER (CASE metric
  {' '.join(f"WHEN '{m}' THEN value BETWEEN {a} AND {b}" for m, a, b in _MONTH_RULES)} END)
  AS rules_passed FROM h GROUP BY ALL)
SELECT table_name, run_id, rules_passed, total_rules, coalesce(n, 0) AS observations,
  CASE WHEN rules_passed / total_rules::DOUBLE >= 0.9 AND n IS NULL THEN 'pass'
    ELSE 'quarantine' END AS decision FROM ok LEFT JOIN ob USING (table_name, run_id)""")
def _(spark, sf_dir):
    """Each month of a status is a run: its rules, and what its history makes of it."""
    runs = settle(monthly_runs(spark, sf_dir), "runs")
    good = F.lit(False)
    for metric, low, high in _MONTH_RULES:
        good = F.when(F.col("metric") == metric, F.col("value").between(low, high)).otherwise(good)
    results = runs.select("table_name", "run_id", F.lit(None).cast("long").alias("total"),
                          F.when(good, "PASS").otherwise("FAIL").alias("outcome"))
    return routing.gate_decision(r.score(results), observations(runs, width=1.5)).select(
        "table_name", "run_id", "rules_passed", "total_rules", "observations", "decision")


# --- joins -------------------------------------------------------------------------------------

@query("join_notes", with_ctes("rec nts joined", "SELECT record_id, md5(note) AS note, "
                                                 "length(note) AS size FROM joined"))
def _(spark, sf_dir):
    out = joins.join_notes(derived.records(spark, sf_dir), derived.notes(spark, sf_dir), "seq")
    return out.select("record_id", F.md5("note").alias("note"), F.length("note").alias("size"))


@query("join_notes_typed", with_ctes("rec nts", """
SELECT record_id, md5(coalesce(t, '')) AS note FROM rec LEFT JOIN (
  SELECT record_id, arg_max(note_text, seq) AS t FROM nts GROUP BY record_id) USING (record_id)"""))
def _(spark, sf_dir):
    out = joins.join_notes_typed(derived.records(spark, sf_dir), derived.notes(spark, sf_dir),
                                 "seq")
    return out.select("record_id", F.md5("note").alias("note"))


_PAIRS = " UNION ALL ".join(
    f"SELECT record_id, '{min(a, b)}' AS drug_1, '{max(a, b)}' AS drug_2, '{sev}' AS severity "
    f"FROM rec WHERE list_contains({NAMES}, '{a}') AND list_contains({NAMES}, '{b}')"
    for a, b, sev, _ in fv.DRUG_INTERACTIONS)


@query("drug_interactions", with_ctes("rec", _PAIRS))
def _(spark, sf_dir):
    names = F.transform("medications", lambda m: m["name"])
    hits = joins.interactions_of(names)
    found_hits = derived.records(spark, sf_dir).select("record_id", unfold(hits)).where(
        "severity is not null")
    return found_hits.select("record_id", F.col("drugs")[0].alias("drug_1"),
                             F.col("drugs")[1].alias("drug_2"), "severity")


@query("drug_interactions_table", with_ctes("rec", _PAIRS))
def _(spark, sf_dir):
    df = derived.records(spark, sf_dir).select(
        "record_id", F.transform("medications", lambda m: m["name"]).alias("names"))
    rules = joins.reference_table(spark, "drug_interactions")
    return joins.interactions_by_table(df, "record_id", "names", rules).drop("description")


@query("subset_test", with_ctes("rec", f"""
SELECT record_id, list_contains({NAMES}, 'Warfarin') AND list_contains({NAMES}, 'Aspirin') AS both
FROM rec WHERE medications IS NOT NULL"""))
def _(spark, sf_dir):
    names = F.transform("medications", lambda m: m["name"])
    return derived.records(spark, sf_dir).where("medications is not null").select(
        "record_id", joins.holds_all(names, ["Warfarin", "Aspirin"]).alias("both"))


@query("lookup_default", with_ctes("rec", f"""
SELECT record_id, code, coalesce(list_extract({listed(d for _, d in fv.ICD10_DESCRIPTIONS)},
  list_position({listed(c for c, _ in fv.ICD10_DESCRIPTIONS)}, code)), 'UNKNOWN') AS description
FROM {DX}"""))
def _(spark, sf_dir):
    codes = derived.records(spark, sf_dir).select(
        "record_id", F.explode("diagnoses").alias("d")).select("record_id", F.col("d.icd10")
                                                               .alias("code"))
    return joins.lookup_default(codes, joins.reference_table(spark, "icd10"), "code",
                                "code", "description", "description")


@query("ref_tables", with_ctes("rec", f"""
SELECT c.code, c.description, count(d.code) AS uses FROM (SELECT
  unnest({listed(c for c, _ in fv.ICD10_DESCRIPTIONS)}) AS code,
  unnest({listed(d for _, d in fv.ICD10_DESCRIPTIONS)}) AS description) c
LEFT JOIN {DX} d ON c.code = d.code GROUP BY ALL"""))
def _(spark, sf_dir):
    uses = (derived.records(spark, sf_dir).select(F.explode("diagnoses").alias("d"))
            .groupBy(F.col("d.icd10").alias("code")).agg(F.count("*").alias("uses")))
    return (joins.reference_table(spark, "icd10").join(uses, "code", "left")
            .withColumn("uses", F.coalesce("uses", F.lit(0))))


@query("validated_semi", with_ctes("rec", "SELECT record_id, mrn FROM rec WHERE record_id IN "
                                          "(SELECT record_id FROM st WHERE status <> 'FAIL')",
                                   st=status_sql(FULL)))
def _(spark, sf_dir):
    kept = routing.validated(validated_frame(spark, sf_dir))
    return joins.only_validated(derived.records(spark, sf_dir), kept).select("record_id", "mrn")


@query("flagged_anti", with_ctes("rec", "SELECT record_id, mrn FROM rec WHERE record_id NOT IN "
                                        "(SELECT record_id FROM st WHERE status <> 'PASS')",
                                 st=status_sql(FULL)))
def _(spark, sf_dir):
    flagged = routing.flagged(validated_frame(spark, sf_dir))
    return joins.without_flagged(derived.records(spark, sf_dir), flagged).select("record_id", "mrn")


# --- summaries over records --------------------------------------------------------------------

@query("first_n_records", with_ctes("rec", "SELECT record_id, mrn, age FROM rec "
                                           "ORDER BY record_id LIMIT 20"))
def _(spark, sf_dir):
    return rec_ops.first_records(derived.records(spark, sf_dir), "record_id").select(
        "record_id", "mrn", "age")


@query("errors_by_type_sorted", with_ctes("rec", """
SELECT row_number() OVER (ORDER BY issues DESC, type) AS place, type, issues FROM (
  SELECT type, count(*) AS issues FROM iss GROUP BY type)""", iss=" UNION ALL ".join(FULL)))
def _(spark, sf_dir):
    from pyspark.sql import Window
    # The result has one row per issue type, so one task can number it.
    by_count = Window.orderBy(F.desc("issues"), "type")
    return summaries.errors_by_type(validated_frame(spark, sf_dir)).select(
        F.row_number().over(by_count).alias("place"), "type", "issues")


@query("udf_rule", with_ctes("rec", """
SELECT record_id, 'DEPARTMENT_MISSING' AS type, 'WARNING' AS severity FROM rec
WHERE department IS NULL"""))
def _(spark, sf_dir):
    def department(df):
        return found(("department IS NULL", issue(
            "DEPARTMENT_MISSING", "department", "WARNING", "'No department'")))

    df = v.validate(derived.records(spark, sf_dir), "basic", AS_OF, extra=[department])
    return df.select("record_id", unfold(F.col(f"{_V}.issues"))).where(
        "type = 'DEPARTMENT_MISSING'").select("record_id", "type", "severity")


def _long_names(names, ages):
    return names.fillna("").combine(ages, lambda n, a: [
        {"type": "LONG_NAME", "field": "patient_name", "severity": "WARNING", "value": n,
         "message": "Name of over ten characters"}] if len(n) > 10 and a == a else [])


@query("udf_rule_pandas", with_ctes("rec", """
SELECT record_id, 'LONG_NAME' AS type, 'WARNING' AS severity, patient_name AS value FROM rec
WHERE length(patient_name) > 10 AND age IS NOT NULL"""))
def _(spark, sf_dir):
    df = v.validate(derived.records(spark, sf_dir), "basic", AS_OF,
                    extra=[v.pandas_check(_long_names, "patient_name", "age")])
    return df.select("record_id", unfold(F.col(f"{_V}.issues"))).where(
        "type = 'LONG_NAME'").select("record_id", "type", "severity", "value")
