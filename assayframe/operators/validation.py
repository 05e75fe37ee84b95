"""Per-record validation: every check is a Column yielding an array of issues."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import fixed_values as fv
from ..functions.predicates import field_type, java_pattern
from ..functions.sql import day, name as quote, number_of, say, text
from .gates import GatePatterns, drop_signals, gate_issues, relevance_score, with_signals
from .issues import (
    ISSUE_TYPE, ISSUES, count_severity, found, found_sql, issue, pinned, status_of, without_detail,
)

LEVELS_WITH_CODES = ("full", "strict")


def _type(df: DataFrame, path: str) -> T.DataType | None:
    try:
        return field_type(df.schema, path)
    except KeyError:
        return None


def _raw(pattern: str) -> str:
    """A pattern as a literal without escapes."""
    return f'r"{pattern}"'


def _gap(df: DataFrame, column: str) -> str:
    dtype, name = _type(df, column), quote(column)
    if dtype is None:
        return "true"
    if column == "age" and _type(df, "age_raw") is not None:
        return "(age IS NULL AND coalesce(age_raw, '') = '')"
    if isinstance(dtype, T.StringType):
        return f"({name} IS NULL OR {name} = '')"
    if isinstance(dtype, T.ArrayType):
        return f"({name} IS NULL OR size({name}) = 0)"
    return f"{name} IS NULL"


def missing_required(df: DataFrame, fields: Sequence[str] = fv.REQUIRED_FIELDS) -> list[Column]:
    return [found((_gap(df, f), issue(
        "MISSING_REQUIRED_FIELD", f, "ERROR",
        text(f"Required field '{f}' is missing or empty")))) for f in fields]


def _not_nan(dtype: T.DataType, number: str) -> str:
    return f" AND NOT isnan({number})" if isinstance(dtype, (T.DoubleType, T.FloatType)) else ""


def invalid_age(df: DataFrame) -> list[Column]:
    """Out of range, or not a number. A reader that keeps raw types (``read_json_strict``)
    hands over a non-numeric age in ``age_raw``."""
    dtype = _type(df, "age")
    if dtype is None:
        return []
    low, high = fv.AGE_RANGE
    bad = "age IS NOT NULL" if isinstance(dtype, T.StringType) else \
        f"(age < {low} OR age > {high}){_not_nan(dtype, 'age')}"
    shown = "CAST(age AS STRING)"
    if _type(df, "age_raw") is not None:
        bad, shown = f"coalesce({bad}, false) OR age_raw IS NOT NULL", f"coalesce(age_raw, {shown})"
    return [found((bad, issue(
        "INVALID_AGE", "age", "ERROR",
        say("'Age '", shown, text(f" is outside valid range [{low}, {high}]")), shown)))]


def invalid_gender(df: DataFrame) -> list[Column]:
    """Not in the set. Null counts as absent unless ``gender_is_null`` says otherwise."""
    if _type(df, "gender") is None:
        return []
    bad = f"gender NOT IN ({', '.join(map(text, fv.GENDERS))})"
    shown = "gender"
    if _type(df, "gender_is_null") is not None:
        bad, shown = f"coalesce({bad}, gender_is_null, false)", "coalesce(gender, 'None')"
    return [found((bad, issue(
        "INVALID_GENDER", "gender", "WARNING",
        say(text("Gender '"), shown, text("' not in standard set (M/F/O/U)")), "gender")))]


def date_checks(df: DataFrame, as_of) -> list[Column]:
    """Order, future, stated length of stay; or one issue when a date does not parse."""
    start, end = (day(c, _type(df, c)) for c in ("admission_date", "discharge_date"))
    shown = {c: f"CAST({c} AS STRING)" if _type(df, c) is not None else "''"
             for c in ("admission_date", "discharge_date")}
    now = "current_timestamp()" if as_of is None else f"CAST({text(str(as_of))} AS TIMESTAMP)"
    both = f"{start} IS NOT NULL AND {end} IS NOT NULL"
    bad_format = f"NOT ({both})"
    checks = [
        found((f"{end} < {start}", issue("DATE_INCONSISTENCY", "discharge_date", "ERROR", say(
            "'Discharge date ('", shown["discharge_date"], "') before admission date ('",
            shown["admission_date"], "')'")))),
        found((f"{both} AND CAST({end} AS TIMESTAMP) > {now}",
               issue("FUTURE_DATE", "discharge_date", "ERROR", say(
                   "'Discharge date ('", shown["discharge_date"], "') is in the future'")))),
    ]
    stated = _type(df, "length_of_stay_days")
    if isinstance(stated, T.NumericType):
        actual = f"datediff({end}, {start})"
        checks.append(found((f"abs({actual} - length_of_stay_days) > 1", issue(
            "LOS_MISMATCH", "length_of_stay_days", "WARNING",
            say("'Stated LOS ('", "CAST(length_of_stay_days AS STRING)",
                text(") doesn't match computed ("), f"CAST({actual} AS STRING)", "')'")))))
    elif stated is not None:
        bad_format += " OR length_of_stay_days IS NOT NULL"
    if _type(df, "length_of_stay_days_raw") is not None:
        bad_format += " OR length_of_stay_days_raw IS NOT NULL"
    checks.append(found((bad_format, issue(
        "INVALID_DATE_FORMAT", None, "ERROR",
        text("Could not parse admission or discharge date (expected YYYY-MM-DD)")))))
    return checks


def invalid_codes(df: DataFrame) -> Column | None:
    if _type(df, "diagnoses") is None:
        return None
    bad = (f"filter(transform(diagnoses, d -> d.icd10), c -> c <> '' AND NOT "
           f"c RLIKE {_raw(java_pattern(fv.ICD10_RECORD_PATTERN))})")
    each = issue("INVALID_ICD10", "diagnoses.icd10", "ERROR", say(
        text("ICD-10 code '"), "c", text("' does not match expected format")), "c")
    return F.expr(_each(bad, "c", each))


def _each(array: str, element: str, what: str) -> str:
    """An issue per element; none for a null array."""
    return (f"coalesce(transform({array}, {element} -> {what}), CAST(array() AS {ISSUES}))")


def vital_checks(df: DataFrame, ranges: Sequence[tuple] = fv.VITAL_RANGES,
                 struct: str = "vitals_at_discharge") -> list[Column]:
    """Not a number, out of range, or in the critical band, for each vital sign."""
    checks = []
    for vital, *bounds in ranges:
        path = f"{struct}.{vital}"
        if _type(df, path) is not None:
            checks.append(range_check(df, path, f"vitals.{vital}", vital, *bounds))
    return checks


def range_check(df: DataFrame, path: str, field: str, label: str, low, high, critical_low,
                critical_high) -> Column:
    """At most one issue for a value with a plausible range and a critical band."""
    dtype, raw = field_type(df.schema, path), quote(path)
    numeric = isinstance(dtype, T.NumericType)
    number = f"CAST({raw} AS DOUBLE)" if numeric else number_of(raw)
    sure = "" if isinstance(dtype, T.IntegralType) else f" AND NOT isnan({number})"
    shown = f"CAST({number} AS STRING)"
    cases = [] if numeric else [(f"{raw} IS NOT NULL AND {number} IS NULL", issue(
        "INVALID_VITAL_VALUE", field, "ERROR",
        text(f"Non-numeric vital sign value for {label}"), f"CAST({raw} AS STRING)"))]
    return found(
        *cases,
        (f"({number} < {float(low)}D OR {number} > {float(high)}D){sure}", issue(
            "VITAL_OUT_OF_RANGE", field, "ERROR",
            say(text(f"{label}="), shown, text(f" outside physiological range [{low}, {high}]")),
            shown)),
        (f"({number} <= {float(critical_low)}D OR {number} >= {float(critical_high)}D){sure}",
         issue("VITAL_CRITICAL", field, "WARNING",
               say(text(f"{label}="), shown, "' is in critical range'"), shown)))


def interaction_issues(df: DataFrame, rules: Sequence[tuple] = fv.DRUG_INTERACTIONS) -> Column | None:
    if _type(df, "medications") is None:
        return None
    names = "transform(medications, m -> m.name)"
    checks = []
    for a, b, severity, description in rules:
        pair = sorted((a, b))
        checks.append(found_sql((
            f"array_contains({names}, {text(a)}) AND array_contains({names}, {text(b)})",
            issue("DRUG_INTERACTION", "medications", "ERROR" if severity == "HIGH" else "WARNING",
                  text(f"Drug interaction ({severity}): {' + '.join(pair)} — {description}"),
                  drugs=f"array({', '.join(map(text, pair))})",
                  interaction_severity=text(severity)))))
    return F.expr(f"concat({', '.join(checks)})") if checks else None


def missing_note(df: DataFrame) -> Column:
    return found((_gap(df, "clinical_note"), issue(
        "MISSING_CLINICAL_NOTE", "clinical_note", "WARNING",
        text("No clinical note attached to record"))))


def bad_doses(df: DataFrame) -> Column | None:
    if _type(df, "medications") is None:
        return None
    bad = (f"filter(transform(medications, m -> m.dose), d -> d <> '' AND NOT "
           f"d RLIKE {_raw(java_pattern(fv.DOSE_PATTERN, True))})")
    each = issue("INVALID_DOSAGE_FORMAT", "medications.dose", "WARNING", say(
        text("Dosage '"), "d", text("' may not be in standard format")), "d")
    return F.expr(_each(bad, "d", each))


def record_issues(df: DataFrame, level: str, as_of,
                  extra: Sequence[Callable[[DataFrame], Column]] = ()) -> Column:
    """All issues of a record, in the order of the checks. ``extra`` are user rules:
    functions from the frame to a Column with an array of issues (see ``issues.found``)."""
    parts = missing_required(df) + invalid_age(df) + invalid_gender(df) + date_checks(df, as_of)
    if level in LEVELS_WITH_CODES:
        parts += [invalid_codes(df), *vital_checks(df), interaction_issues(df)]
    if level == "strict":
        parts += [missing_note(df), bad_doses(df)]
    parts += [rule(df) for rule in extra]
    return F.concat(*[p for p in parts if p is not None])


def pandas_check(check, *columns: str):
    """A check for ``validate(extra=...)`` from a function on Arrow batches: it gets the
    columns as pandas Series and returns a Series of lists of issues (dicts with the fields of
    ``ISSUE_TYPE``; those left out are null). Only these columns pass through pandas."""
    names = T.StructType.fromDDL(ISSUE_TYPE[len("struct<"):-1]).names

    @F.pandas_udf(ISSUES)
    def run(*series: pd.Series) -> pd.Series:
        return check(*series).map(lambda found: [
            {n: i.get(n) for n in names} for i in found or []])

    return lambda df: run(*[F.col(c) for c in columns])


def validate(df: DataFrame, level: str = "full", as_of=None, note: str | None = None,
             record_id: str = "record_id", patterns: GatePatterns = GatePatterns(),
             extra: Sequence[Callable[[DataFrame], Column]] = (), detail: bool = True) -> DataFrame:
    """Adds ``_validation``: status, issues, counts and relevance score.

    ``full`` and ``strict`` also run the text gates over ``note``. Everything is one
    narrow projection: no shuffle, no Python. Without ``detail`` issues have their type and
    severity alone, which is all that counts, summaries and metrics need.
    """
    if not detail:
        with without_detail():
            return validate(df, level, as_of, note, record_id, patterns, extra)
    issues = record_issues(df, level, as_of, extra)
    out, relevance = df, F.lit(None).cast("double")
    if level in LEVELS_WITH_CODES and note is not None:
        out = with_signals(out, note, patterns)
        issues = F.concat(issues, gate_issues(record_id))
        relevance = relevance_score()
    errors, warnings = F.col("_errors"), F.col("_warnings")
    out = (pinned(out, {"_issues": issues, "_relevance": relevance})
           .withColumns({"_errors": count_severity(F.col("_issues"), "ERROR"),
                         "_warnings": count_severity(F.col("_issues"), "WARNING")})
           .withColumn("_validation", F.struct(
               status_of(errors, warnings).alias("status"), F.col("_issues").alias("issues"),
               errors.alias("error_count"), warnings.alias("warning_count"),
               F.col("_relevance").alias("relevance_score"))))
    return drop_signals(out.drop("_issues", "_relevance", "_errors", "_warnings"))
