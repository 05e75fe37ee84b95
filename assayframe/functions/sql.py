"""Pieces of SQL expression text.

Rules and checks come by the dozen; written as expression text each is parsed once on the
JVM, where a tree of Column calls would cross the Python gateway for every node.
"""

from __future__ import annotations

from pyspark.sql import types as T

NULL = "CAST(NULL AS STRING)"


def text(value: str | None) -> str:
    """A string literal."""
    if value is None:
        return NULL
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def name(column: str) -> str:
    """A column or dotted field, quoted."""
    return ".".join(f"`{part}`" for part in column.split("."))


def number(value) -> str:
    """A numeric literal; fractions as doubles."""
    return repr(value) + ("D" if isinstance(value, float) else "")


def literal(value) -> str:
    return text(value) if isinstance(value, str) else number(value)


def say(*parts: str) -> str:
    """Concatenation of SQL expressions."""
    return f"concat({', '.join(parts)})"


def missing(column: str, dtype: T.DataType) -> str:
    """Null, empty or the text ``None``. Blanks made of spaces are values."""
    col = name(column)
    if isinstance(dtype, T.StringType):
        return f"({col} IS NULL OR {col} IN ('', 'None'))"
    return f"{col} IS NULL"


def day(column: str, dtype: T.DataType | None) -> str:
    """Date of a ``yyyy-M-d`` text (null when it does not parse), or of a date column."""
    if dtype is None:
        return "CAST(NULL AS DATE)"
    if isinstance(dtype, T.StringType):
        return f"try_to_date({name(column)}, 'yyyy-M-d')"
    return f"CAST({name(column)} AS DATE)"


def outside(column: str, dtype: T.DataType, low=None, high=None) -> str:
    """True where the value lies outside the bounds; null and NaN are not outside."""
    col = name(column)
    tests = [f"{col} < {number(low)}"] if low is not None else []
    tests += [f"{col} > {number(high)}"] if high is not None else []
    real = f" AND NOT isnan({col})" if isinstance(dtype, (T.DoubleType, T.FloatType)) else ""
    return f"coalesce(({' OR '.join(tests)}){real}, false)"


def number_of(value: str, whole: bool = False) -> str:
    """The number a text holds from end to end, else null. A cast alone also reads ``98.6F``
    and ``37d``, and cuts fractions off whole numbers."""
    digits = "[0-9]+" if whole else "([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?"
    named = "" if whole else "|nan|inf|infinity"
    kind = "BIGINT" if whole else "DOUBLE"
    return (f"CASE WHEN {value} RLIKE '(?i)^ *[+-]?({digits}{named}) *$' "
            f"THEN TRY_CAST(trim({value}) AS {kind}) END")


def share(part: str, whole: str) -> str:
    return f"coalesce(try_divide({part}, {whole}), 0D)"
