"""Entities in notes: extraction, grouping by category, first matches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as fv
from ..functions.predicates import java_pattern
from ..functions.sql import name, text
from .issues import pinned

ENTITY = ("struct<id:int,text:string,category:string,type:string,score:double,begin:int,end:int,"
          "traits:array<struct<name:string,score:double>>,normalized:string>")


def _entity(found, category, kind, score, begin, end, trait=None, normalized=None) -> str:
    traits = f"array(named_struct('name', {text(trait[0])}, 'score', {trait[1]}D))" if trait \
        else "array()"
    return (f"CAST(named_struct('id', 0, 'text', {found}, 'category', {text(category)}, 'type', "
            f"{text(kind)}, 'score', {score}D, 'begin', {begin}, 'end', {end}, 'traits', {traits}, "
            f"'normalized', {text(normalized)}) AS {ENTITY})")


def _keyword(source, keyword, category, kind, score, trait=None, normalized=None) -> str:
    at, size = f"instr(_lowered, {text(keyword.lower())})", len(keyword)
    found = _entity(f"substring({source}, {at}, {size})", category, kind, score, f"{at} - 1",
                    f"{at} - 1 + {size}", trait, normalized)
    return f"CASE WHEN {at} > 0 THEN array({found}) ELSE CAST(array() AS array<{ENTITY}>) END"


def running_totals(lengths: Column) -> Column:
    """Sums of an int array up to each element, in as many passes as its size has digits
    in base two: each pass adds the totals one, two, four, ... places before."""
    def add_shifted(totals, shift):
        earlier = F.concat(F.array_repeat(F.lit(0), shift), totals)
        added = F.zip_with(totals, earlier, lambda x, y: x + y)
        return F.when(F.size(totals) <= shift, totals).otherwise(
            F.slice(added, F.lit(1), F.size(totals)))

    shifts = F.expr("transform(sequence(0, 30), k -> shiftleft(1, k))")
    return F.aggregate(shifts, lengths, add_shifted)


def all_matches(body: Column, pattern: str) -> Column:
    """Every match with its offsets: array of (text, begin, end), 0-based, end-exclusive.

    A match ends where the gaps and matches up to it end.
    """
    regex = java_pattern(pattern)
    found = F.regexp_extract_all(body, F.lit(regex), F.lit(0))
    gaps = F.split(body, regex, -1)
    steps = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)),
                       lambda m, g: F.length(g) + F.length(m))
    return F.zip_with(found, running_totals(steps), lambda m, end: F.struct(
        m.alias("text"), (end - F.length(m)).alias("begin"), end.alias("end")))


def with_entities(df: DataFrame, column: str, into: str = "entities",
                  medications: Sequence[str] = fv.MEDICATION_KEYWORDS,
                  conditions: Sequence[tuple[str, str]] = fv.CONDITION_KEYWORDS,
                  date_pattern: str = fv.DATE_ENTITY_PATTERN) -> DataFrame:
    """Adds the entities of a text: the first occurrence of each keyword, whatever its
    case, then every date. Ids count up in that order."""
    body = F.coalesce(F.col(column), F.lit(""))
    source = f"coalesce({name(column)}, '')"
    trait = ("DIAGNOSIS", fv.DIAGNOSIS_TRAIT_SCORE)
    keywords = [_keyword(source, m, "MEDICATION", "GENERIC_NAME", fv.MEDICATION_SCORE)
                for m in medications]
    keywords += [_keyword(source, k, "MEDICAL_CONDITION", "DX_NAME", fv.CONDITION_SCORE, trait,
                          normal) for k, normal in conditions]
    dates = "transform(_dates, d -> {})".format(_entity(
        "d.text", "PROTECTED_HEALTH_INFORMATION", "DATE", fv.DATE_SCORE, "d.begin", "d.end"))
    none = F.array().cast("array<struct<text:string,begin:int,end:int>>")
    with_dates = F.when(body.rlike(java_pattern(date_pattern)),
                        all_matches(body, date_pattern)).otherwise(none)
    found = df.withColumns({"_lowered": F.lower(body), "_dates": with_dates}).withColumn(
        "_found", F.expr(f"concat({', '.join([*keywords, dates])})"))
    return pinned(found, {into: F.transform("_found", lambda e, i: e.withField("id", i))}).drop(
        "_lowered", "_dates", "_found")


def with_custom_entities(df: DataFrame, column: str,
                         extractor: Callable[[pd.Series], pd.Series],
                         into: str = "entities") -> DataFrame:
    """Entities from the caller's own extractor: a function from a batch of texts to a
    batch of entity lists. Only the text passes through pandas; other columns never do."""
    if into in df.columns:
        raise ValueError(f"{into} is already a column")

    @F.pandas_udf(f"array<{ENTITY}>")
    def run(texts: pd.Series) -> pd.Series:
        return extractor(texts)

    return df.withColumn(into, run(F.col(column)))


def standardize(entities: Column) -> Column:
    """Entities grouped by category, with a flag for personal data."""
    def of(category, *extra):
        return F.transform(
            F.filter(entities, lambda e: e["category"] == category),
            lambda e: F.struct(e["text"].alias("text"), e["score"].alias("confidence"),
                               e["type"].alias("type"),
                               *[F.coalesce(e[x], e["text"]).alias(x) for x in extra]))

    personal = of("PROTECTED_HEALTH_INFORMATION")
    return F.struct(
        of("MEDICATION").alias("medications"),
        of("MEDICAL_CONDITION", "normalized").alias("conditions"),
        personal.alias("dates"), of("TEST_TREATMENT_PROCEDURE").alias("procedures"),
        of("ANATOMY").alias("anatomy"), (F.size(personal) > 0).alias("phi_detected"))


def first_matches(body: Column, pattern: str, k: int = 3, group: int = 0) -> Column:
    """The first ``k`` matches of a pattern, whatever their case."""
    return F.slice(F.regexp_extract_all(body, F.lit(java_pattern(pattern, True)), F.lit(group)),
                   1, k)
