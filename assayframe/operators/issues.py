"""The issue struct all validation and gate checks share, written as SQL expressions."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.sql import NULL, text

ISSUE_TYPE = ("struct<type:string,field:string,severity:string,value:string,message:string,"
              "drugs:array<string>,interaction_severity:string>")
ISSUES = f"array<{ISSUE_TYPE}>"


_detail: ContextVar[bool] = ContextVar("detail", default=True)


@contextmanager
def without_detail() -> Iterator[None]:
    """Issues built inside tell their type and severity only: no message or value is made."""
    token = _detail.set(False)
    try:
        yield
    finally:
        _detail.reset(token)


def issue(kind: str, field: str | None, severity: str, message: str, value: str = NULL,
          drugs: str = "CAST(NULL AS ARRAY<STRING>)", interaction_severity: str = NULL) -> str:
    """An issue struct; ``message``, ``value`` and what follows are SQL expressions, and so
    is a severity that is neither ERROR nor WARNING."""
    severity = text(severity) if severity in ("ERROR", "WARNING") else severity
    if not _detail.get():
        value = message = interaction_severity = NULL
        drugs = "CAST(NULL AS ARRAY<STRING>)"
    return (f"named_struct('type', {text(kind)}, 'field', {text(field)}, 'severity', {severity}, "
            f"'value', {value}, 'message', {message}, 'drugs', {drugs}, "
            f"'interaction_severity', {interaction_severity})")


def found_sql(*cases: tuple[str, str]) -> str:
    """An array with the issue of the first case (test, issue) that holds, or an empty one."""
    whens = " ".join(f"WHEN {test} THEN array({what})" for test, what in cases)
    return f"CASE {whens} ELSE CAST(array() AS {ISSUES}) END"


def found(*cases: tuple[str, str]) -> Column:
    """The same as a Column. Checks are joined with ``concat``: unlike a filter over an
    array of nulls it is compiled with the rest of the projection."""
    return F.expr(found_sql(*cases))


def unfold(array: Column) -> Column:
    """One row per element, for arrays that are computed.

    The plain generators make the optimizer test the array for emptiness in a filter
    below, which computes it twice; the outer one does not. Rows of empty arrays come out
    as nulls, to be filtered by a field that is never null.
    """
    return F.inline_outer(array)


def pinned(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds costly columns that are computed once per row.

    A plain projection is copied into every filter on its results, and so computed before
    and after the filter; the output of a generator is not. The columns themselves are
    computed in a projection below, which is compiled; the generator only passes them on.
    """
    below = {f"_below_{n}": value for n, value in columns.items()}
    row = F.struct(*[F.col(f"_below_{n}").alias(n) for n in columns])
    return df.withColumns(below).select("*", F.inline_outer(F.array(row))).drop(*below)


def count_severity(issues: Column, severity: str) -> Column:
    return F.size(F.filter(issues, lambda i: i["severity"] == severity))


def status_of(errors: Column, warnings: Column) -> Column:
    """FAIL with any error, else WARNING with any warning, else PASS."""
    return F.when(errors > 0, "FAIL").when(warnings > 0, "WARNING").otherwise("PASS")
