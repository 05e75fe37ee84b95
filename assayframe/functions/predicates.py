"""Column predicates shared by rules, analyzers and validation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

#: Members of a class of white space as Python sees it; needs the flag ``(?U)``.
SPACE = r"\s\x1C-\x1F"
GAP = f"(?U)[{SPACE}]+"


def field_type(schema: T.StructType, path: str) -> T.DataType:
    """Type of a column or a dotted struct field; KeyError when it is not there."""
    dtype: T.DataType = schema
    for name in path.split("."):
        if not isinstance(dtype, T.StructType) or name not in dtype.names:
            raise KeyError(path)
        dtype = dtype[name].dataType
    return dtype


def missing(col: Column, dtype: T.DataType) -> Column:
    """Null, empty or the text ``None``. Blanks made of spaces are values."""
    if isinstance(dtype, T.StringType):
        return col.isNull() | col.isin("", "None")
    return col.isNull()


def required_missing(col: Column, dtype: T.DataType) -> Column:
    """Null, empty text or empty array."""
    if isinstance(dtype, T.StringType):
        return col.isNull() | (col == "")
    if isinstance(dtype, T.ArrayType):
        return col.isNull() | (F.size(col) == 0)
    return col.isNull()


def java_pattern(pattern: str, ignore_case: bool = False) -> str:
    return f"(?{'i' if ignore_case else ''}Ud){pattern}"


def match_count(col: Column, pattern: str) -> Column:
    """Matches of a pattern of one character or more, as the cuts that they make: a text is cut
    several times faster than its matches are found one by one and kept to be counted."""
    return F.size(F.split(col, pattern)) - 1


def word_count(col: Column) -> Column:
    """Words of a text: its gaps, with blanks around it."""
    blank = F.lit(" ")
    return match_count(F.concat(blank, col, blank), GAP) - 1
