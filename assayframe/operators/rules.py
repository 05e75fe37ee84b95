"""Declarative data-quality rules.

A rule is a set of aggregate expressions over a table. All rules of a table that need
nothing but its rows are evaluated in one aggregation, so the table is scanned once
however many rules there are; Catalyst merges equal aggregates between rules. Only
uniqueness (which has to shuffle its key) and free SQL run beside that scan.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions import fixed_values as fv
from ..functions.predicates import field_type, java_pattern
from ..functions.sql import NULL, day, literal, missing, name, number, outside, share, text

RESULT_COLUMNS = [
    "table_name", "run_id", "rule_id", "rule", "type", "column",
    "total", "checked", "violations", "metric", "outcome",
]


@dataclass(frozen=True)
class Measures:
    """What one rule computes over a table, as SQL expressions.

    The first four are aggregates; ``offends`` and ``value`` belong to a row. ``sample`` is
    a value for reports, whose text ``{chars}`` cuts.
    """

    checked: str
    violations: str
    metric: str
    passed: str
    offends: str | None = None
    value: str = NULL
    sample: str | None = None


@dataclass(frozen=True)
class Rule:
    text: str
    type: str
    column: str | None = None
    measure: Callable[[T.StructType], Measures] | None = None
    unique_key: tuple[str, ...] = ()
    sql: str | None = None
    accept: str | None = None


NO_COUNT = "CAST(NULL AS BIGINT)"
#: Characters of an offending text that a report's samples show, by kind of rule.
SAMPLE_CHARS = {"pattern": 80, "length": 50}


def _numeric(schema: T.StructType, column: str) -> T.DataType:
    dtype = field_type(schema, column)
    if not isinstance(dtype, T.NumericType):
        raise TypeError(f"{column} is not numeric")
    return dtype


def _text_of(schema: T.StructType, column: str) -> str:
    dtype = field_type(schema, column)
    return name(column) if isinstance(dtype, T.StringType) else f"CAST({name(column)} AS STRING)"


def _share_measures(checked: str, bad: str, threshold: float | None, value: str,
                    sample: str | None = None) -> Measures:
    """A rule on the share of checked rows that are not bad: all, or ``threshold``."""
    count = f"count_if({bad})"
    good = share(f"{checked} - {count}", checked)
    passed = f"{count} = 0" if threshold is None else f"{good} >= {number(float(threshold))}"
    return Measures(checked, count, f"round({good}, 4)", passed, bad, value, sample)


def _count_measures(checked: str, bad: str, most: int, value: str) -> Measures:
    """A rule on the number of bad rows."""
    count = f"count_if({bad})"
    return Measures(checked, count, count, f"{count} <= {most}", bad, value)


def completeness(column: str, threshold: float) -> Rule:
    """Share of rows whose value is not missing, at least ``threshold``."""

    def measure(schema):
        gap = missing(column, field_type(schema, column))
        return _share_measures("count(*)", gap, threshold, _text_of(schema, column))

    return Rule(f'Completeness "{column}" >= {threshold}', "Completeness", column, measure)


def is_complete(column: str) -> Rule:
    inner = completeness(column, 1.0)
    return Rule(f'IsComplete "{column}"', "Completeness", column, inner.measure)


def _bounds_rule(rule_text, rule_type, column, low, high, null_policy, threshold):
    if null_policy not in ("skip", "fail"):
        raise ValueError(f"null_policy: {null_policy}")

    def measure(schema):
        bad, checked = outside(column, _numeric(schema, column), low, high), f"count({name(column)})"
        if null_policy == "fail":
            bad, checked = f"({bad} OR {name(column)} IS NULL)", "count(*)"
        return _share_measures(checked, bad, threshold, _text_of(schema, column))

    return Rule(rule_text, rule_type, column, measure)


def value_range(column, low, high, null_policy="skip", threshold=None) -> Rule:
    """All values inside ``[low, high]``, or at least the share ``threshold`` of them.

    ``null_policy="skip"`` leaves nulls out; ``"fail"`` counts a null as a violation.
    """
    rule_text = f'ColumnValues "{column}" between {low} and {high}'
    if threshold is not None:
        rule_text += f" with threshold >= {threshold}"
    return _bounds_rule(rule_text, "Range", column, low, high, null_policy, threshold)


def minimum(column, low, null_policy="skip") -> Rule:
    return _bounds_rule(f'ColumnValues "{column}" >= {low}', "Range", column, low, None,
                        null_policy, None)


def nested_range(path, low, high) -> Rule:
    """Range of a struct field; rows whose struct or field is null are skipped."""
    return _bounds_rule(f"CustomSql: {path} between {low} and {high}", "NestedRange", path,
                        low, high, "skip", None)


def unique(*columns: str) -> Rule:
    """Distinct over non-null values equals one. A table without values passes."""
    listed = ", ".join(columns)
    return Rule(f'Uniqueness "{listed}" = 1.0', "Uniqueness", listed, unique_key=tuple(columns))


def date_order(start: str, end: str, rule_text: str | None = None) -> Rule:
    """No ``end`` before ``start``; rows with a date that does not parse are skipped."""

    def measure(schema):
        first, last = (day(c, field_type(schema, c)) for c in (start, end))
        checked = f"count_if({first} IS NOT NULL AND {last} IS NOT NULL)"
        value = f"concat_ws(' < ', {_text_of(schema, end)}, {_text_of(schema, start)})"
        return _share_measures(checked, f"coalesce({last} < {first}, false)", None, value)

    return Rule(rule_text or f"CustomSql: {end} >= {start}", "Consistency", end, measure)


def pattern(column, regex, threshold=1.0, rule_text=None, rule_type="RegexMatch") -> Rule:
    """Share of non-empty values that match from their start; none at all fails."""

    def measure(schema):
        col = _text_of(schema, column)
        eligible = f"coalesce({col} <> '', false)"
        bad = f"({eligible} AND NOT {col} RLIKE {text(java_pattern(f'^(?:{regex})'))})"
        return _share_measures(f"count_if({eligible})", bad, threshold, col,
                               f"substring({col}, 1, {{pattern}})")

    rule_text = rule_text or f'ColumnValues "{column}" matches "{regex}" (threshold >= {threshold})'
    return Rule(rule_text, rule_type, column, measure)


def icd10(column: str, threshold: float = 0.90) -> Rule:
    return pattern(column, fv.ICD10_RULE_PATTERN, threshold, rule_type="Format",
                   rule_text=f'ColumnValues "{column}" matches ICD-10 pattern '
                             f"(threshold >= {threshold:.2f})")


def values_in(column: str, allowed: Sequence) -> Rule:
    """Every non-null value is allowed; the empty text is a value."""

    def measure(schema):
        value = _text_of(schema, column)
        bad = f"coalesce({name(column)} NOT IN ({', '.join(map(literal, allowed))}), false)"
        return _share_measures(f"count({name(column)})", bad, None, value)

    return Rule(f'ColumnValues "{column}" in {list(allowed)}', "ValueSet", column, measure)


def length_min(column: str, least: int) -> Rule:
    def measure(schema):
        col = _text_of(schema, column)
        eligible = f"coalesce({col} <> '', false)"
        return _share_measures(
            f"count_if({eligible})", f"({eligible} AND length({col}) < {least})", None,
            f"concat({col}, ' (length ', length({col}), ')')",
            f"concat(substring({col}, 1, {{length}}), ' (length ', length({col}), ')')")

    return Rule(f'ColumnLength "{column}" >= {least}', "ColumnLength", column, measure)


def length_between(column: str, low: int, high: int, threshold: float = 1.0) -> Rule:
    """Share of non-empty texts whose length lies in ``[low, high]``."""

    def measure(schema):
        col = _text_of(schema, column)
        eligible = f"coalesce({col} <> '', false)"
        bad = f"({eligible} AND length({col}) NOT BETWEEN {low} AND {high})"
        return _share_measures(f"count_if({eligible})", bad, threshold,
                               f"CAST(length({col}) AS STRING)")

    return Rule(f'ColumnLength "{column}" between {low} and {high} with threshold >= {threshold}',
                "ColumnLength", column, measure)


def array_not_empty(column: str, max_empty: int = 0) -> Rule:
    """At most ``max_empty`` rows hold an empty array. A null array is not empty."""

    def measure(schema):
        if not isinstance(field_type(schema, column), (T.ArrayType, T.MapType)):
            raise TypeError(f"{column} is not an array")
        col = name(column)
        bad = f"({col} IS NOT NULL AND size({col}) = 0)"
        return _count_measures(f"count({col})", bad, max_empty, "'[]'")

    return Rule(f"CustomSql: size({column}) = 0 count <= {max_empty}", "ArrayNotEmpty", column,
                measure)


def null_count(column: str, max_null: int) -> Rule:
    def measure(schema):
        field_type(schema, column)
        return _count_measures("count(*)", f"{name(column)} IS NULL", max_null, NULL)

    return Rule(f"CustomSql: {column} IS NULL count <= {max_null}", "NullCheck", column, measure)


def _statistic_rule(rule_text, column, aggregate, test):
    def measure(schema):
        _numeric(schema, column)
        value = f"{aggregate}({name(column)})"
        return Measures(f"count({name(column)})", NO_COUNT, f"round({value}, 2)",
                        f"coalesce({value} {test}, false)")

    return Rule(rule_text, "Statistical", column, measure)


def mean_between(column, low, high) -> Rule:
    return _statistic_rule(f'Mean "{column}" between {low} and {high}', column, "avg",
                           f"BETWEEN {number(low)} AND {number(high)}")


def stddev_max(column, most) -> Rule:
    """Sample standard deviation; fewer than two values fail."""
    return _statistic_rule(f'StandardDeviation "{column}" <= {most}', column, "stddev_samp",
                           f"<= {number(most)}")


def stddev_between(column, low, high) -> Rule:
    return _statistic_rule(f'StandardDeviation "{column}" between {low} and {high}', column,
                           "stddev_samp", f"BETWEEN {number(low)} AND {number(high)}")


def row_count(least=None, most=None, equal=None) -> Rule:
    if equal is not None:
        rule_text, test = f"RowCount = {equal}", f"= {equal}"
    elif most is None:
        rule_text, test = f"RowCount >= {least}", f">= {least}"
    else:
        rule_text, test = f"RowCount between {least} and {most}", f"BETWEEN {least} AND {most}"
    measures = Measures("count(*)", NO_COUNT, "count(*)", f"count(*) {test}")
    return Rule(rule_text, "RowCount", None, lambda schema: measures)


def where_count(condition: str, most: int = 0) -> Rule:
    """``SELECT COUNT(*) FROM primary WHERE condition`` at most ``most``, in the fused scan."""
    measures = _count_measures("count(*)", f"coalesce(({condition}), false)", most,
                               text(condition))
    compare = "=" if most == 0 else "<="
    return Rule(f'CustomSql "SELECT COUNT(*) FROM primary WHERE {condition}" {compare} {most}',
                "CustomSql", None, lambda schema: measures)


def custom_sql(sql: str, compare: str, value: float) -> Rule:
    """Any SQL over the view ``primary`` that gives one number, compared by =, <= or >=."""
    if compare not in ("=", "<=", ">="):
        raise ValueError(f"compare: {compare}")
    return Rule(f'CustomSql "{sql}" {compare} {value}', "CustomSql", None, sql=sql,
                accept=f"{compare} {number(value)}")


# --- evaluation ------------------------------------------------------------------------

_PASSED = "CASE WHEN {p} THEN 'PASS' ELSE 'FAIL' END"


def _result(rule, table_name, run_id, rule_id, total="NULL", checked="NULL", violations="NULL",
            metric="NULL", outcome="'ERROR'") -> str:
    """A result struct; the measures are names of columns or SQL expressions."""
    fields = {
        "table_name": text(table_name), "run_id": text(run_id),
        "rule_id": f"CAST({rule_id} AS INT)", "rule": text(rule.text), "type": text(rule.type),
        "column": text(rule.column), "total": f"CAST({total} AS BIGINT)",
        "checked": f"CAST({checked} AS BIGINT)", "violations": f"CAST({violations} AS BIGINT)",
        "metric": f"CAST({metric} AS DOUBLE)", "outcome": outcome}
    return f"named_struct({', '.join(f'{text(k)}, {v}' for k, v in fields.items())})"


def _uniqueness(df, rule, ids):
    # Two levels: counts per key are combined on the map side, so a key that holds a
    # large part of the rows costs one row per task. Only the key columns are read.
    present = F.expr(" AND ".join(f"{name(c)} IS NOT NULL" for c in rule.unique_key))
    counts = df.where(present).groupBy(*rule.unique_key).agg(F.count("*").alias("n"))
    return (counts.selectExpr("coalesce(sum(n), 0) AS t", "count(*) AS u")
            .selectExpr(_result(*ids, "t", "t", "t - u", "round(coalesce(try_divide(u, t), 0), 4)",
                                _PASSED.format(p="t = u")) + " AS r").select("r.*"))


def _free_sql(df, rule, ids):
    """Runs the statement now, apart from the fused scan: an error of its own is the rule's
    result and ends no other rule. It has to give one row with one number."""
    spark, view = df.sparkSession, f"primary_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        answer = spark.sql(f"WITH primary AS (SELECT * FROM {view}) SELECT * FROM ({rule.sql})")
        if len(answer.columns) != 1:
            raise TypeError("custom SQL must give one number")
        rows = answer.limit(2).collect()
        if len(rows) != 1:
            raise TypeError("custom SQL must give one row")
        value = rows[0][0]
        metric = "NULL" if value is None else f"CAST({text(str(float(value)))} AS DOUBLE)"
    except (PySparkException, ValueError) as error:
        raise TypeError(str(error)) from error
    finally:
        spark.catalog.dropTempView(view)
    outcome = _PASSED.format(p=f"{metric} {rule.accept}")
    return spark.range(1).selectExpr(
        _result(*ids, metric=metric, outcome=outcome) + " AS r").select("r.*")


def _aggregates(m: Measures, i: int) -> list[str]:
    return [f"{m.checked} AS c{i}", f"{m.violations} AS v{i}", f"{m.metric} AS m{i}",
            f"{m.passed} AS p{i}"]


def evaluate(df: DataFrame, rules: Sequence[Rule], table_name: str, run_id: str = "") -> DataFrame:
    """One row per rule: counts, metric and PASS, FAIL or ERROR.

    A rule that cannot be run (its column is missing or of the wrong type) is ERROR.
    """
    fused, frames, results = {}, [], []
    for i, rule in enumerate(rules, start=1):
        ids = (rule, table_name, run_id, i)
        try:
            if rule.sql is not None:
                frames.append(_free_sql(df, rule, ids))
            elif rule.unique_key:
                for key in rule.unique_key:
                    field_type(df.schema, key)
                frames.append(_uniqueness(df, rule, ids))
            else:
                fused[i] = _aggregates(rule.measure(df.schema), i)
                results.append((i, _result(*ids, "total", f"c{i}", f"v{i}", f"m{i}",
                                           _PASSED.format(p=f"p{i}"))))
        except (KeyError, TypeError, AnalysisException):
            results.append((i, _result(*ids)))
    if results:
        usable = _analyzable(df, fused)
        rows = ", ".join(row if i in usable or i not in fused else
                         _result(rules[i - 1], table_name, run_id, i) for i, row in results)
        scan = df.selectExpr("count(*) AS total", *[c for i in usable for c in fused[i]])
        frames.insert(0, scan.selectExpr(f"inline_outer(array({rows}))"))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _analyzable(df: DataFrame, fused: dict[int, list[str]]) -> list[int]:
    """The rules whose aggregates the table's types allow."""
    def fits(ids):
        try:
            df.selectExpr("count(*)", *[c for i in ids for c in fused[i]])
            return True
        except AnalysisException:
            return False

    return list(fused) if fits(fused) else [i for i in fused if fits([i])]


def violations(df: DataFrame, rules: Sequence[Rule], table_name: str, record_id: str,
               keep: int = 10, chars: dict[str, int] = SAMPLE_CHARS) -> DataFrame:
    """The first ``keep`` offending rows of each rule, by record id.

    These are samples for a report: ``chars`` says how much of a text they show that breaks a
    pattern or length rule. ``tagged`` and ``route_rows`` keep whole values.

    Each row yields only the rules it breaks; the window limit runs before the shuffle,
    so a task sends at most ``keep`` rows per rule.
    """
    window = Window.partitionBy("rule_id").orderBy("_key", "value")
    return (tagged(df, rules, chars)
            .select(F.col(record_id).alias("_key"), F.inline_outer("violated"))
            .where("rule_id is not null")
            .withColumn("rank", F.row_number().over(window))
            .where(F.col("rank") <= keep)
            .select(F.lit(table_name).alias("table_name"), "rule_id",
                    F.col("_key").cast("string").alias("record_id"), "value", "rank"))


def tagged(df: DataFrame, rules: Sequence[Rule],
           chars: dict[str, int] | None = None) -> DataFrame:
    """Adds ``violated``: the id and offending value of each row-level rule a row breaks.

    Values are whole unless ``chars`` asks for samples.
    """
    tag = "array<struct<rule_id:int,rule:string,value:string>>"
    none = f"CAST(array() AS {tag})"
    tags = [none]
    for rule_id, rule in enumerate(rules, start=1):
        try:
            m = rule.measure(df.schema) if rule.measure else None
        except (KeyError, TypeError):
            continue
        if m and m.offends:
            value = m.sample.format(**chars) if chars and m.sample else m.value
            tags.append(f"CASE WHEN {m.offends} THEN array(named_struct('rule_id', {rule_id}, "
                        f"'rule', {text(rule.text)}, 'value', {value})) ELSE {none} END")
    return df.withColumn("violated", F.expr(f"concat({', '.join(tags)})"))


# --- scores ----------------------------------------------------------------------------

def _score_columns():
    passed = F.count_if(F.col("outcome") == "PASS")
    rules = F.count("*")
    return [
        rules.alias("total_rules"), passed.alias("rules_passed"),
        (rules - passed).alias("rules_failed"),
        F.coalesce(F.round(F.try_divide(passed * 100.0, rules), 1), F.lit(0.0))
        .alias("overall_score"),
        F.coalesce(F.max("total"), F.lit(0)).cast("long").alias("total_records"),
    ]


def score(results: DataFrame) -> DataFrame:
    """Passed, failed and percentage per table and run."""
    return results.groupBy("table_name", "run_id").agg(*_score_columns())


def score_all(results: DataFrame) -> DataFrame:
    """Per-table scores and, with a null table name, the total over all of them."""
    passed = F.count_if(F.col("outcome") == "PASS")
    return results.rollup("table_name").agg(
        F.count("*").alias("total_rules"), passed.alias("rules_passed"),
        (F.count("*") - passed).alias("rules_failed"),
        F.coalesce(F.round(F.try_divide(passed * 100.0, F.count("*")), 1), F.lit(0.0))
        .alias("overall_score"))


def outcome_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("run_id", "outcome").agg(F.count("*").alias("rules"))


def score_from_counts(df: DataFrame, passed: str, failed: str) -> DataFrame:
    return df.withColumn("score", F.try_divide(F.col(passed), F.col(passed) + F.col(failed)))
