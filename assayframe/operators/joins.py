"""Joins: notes, interactions, look-ups with a default, cross-table dates, kept records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as fv


def last_per_key(df: DataFrame, key: str, order: str, *values: str) -> DataFrame:
    """One row per key, the one with the greatest ``order``.

    An aggregate, not a window: tasks merge their own rows first, so many copies of one
    key never meet in one place.
    """
    newest = F.max_by(F.struct(*values), F.col(order))
    return df.groupBy(key).agg(newest.alias("_last")).select(key, "_last.*")


def join_notes(records: DataFrame, notes: DataFrame, order: str, record_id: str = "record_id",
               text: str = "note_text", inline: str = "clinical_note",
               into: str = "note") -> DataFrame:
    """Records with their note: the last one mapped by the text of the id, else the
    inline note when that is empty, else the empty text."""
    key = F.col(record_id).cast("string")
    mapped = last_per_key(notes.select(key.alias("_key"), F.col(text).alias("_text"), order),
                          "_key", order, "_text")
    fallback = F.col(inline) if inline in records.columns else F.lit(None).cast("string")
    return (records.withColumn("_key", key).join(mapped, "_key", "left")
            .withColumn(into, F.coalesce(F.nullif(F.col("_text"), F.lit("")), fallback,
                                         F.lit("")))
            .drop("_key", "_text"))


def join_notes_typed(records: DataFrame, notes: DataFrame, order: str,
                     record_id: str = "record_id", text: str = "note_text",
                     into: str = "note") -> DataFrame:
    """The same on the native key, without fallback."""
    mapped = last_per_key(notes.select(record_id, F.col(text).alias("_text"), order),
                          record_id, order, "_text")
    return (records.join(mapped, record_id, "left")
            .withColumn(into, F.coalesce("_text", F.lit(""))).drop("_text"))


def interactions_of(names: Column, rules: Sequence[tuple] = fv.DRUG_INTERACTIONS) -> Column:
    """Rules whose two names are both in the array, as structs, in rule order.

    For a few rules: no join and no shuffle, the rules are part of the expression.
    """
    none = F.array().cast("array<struct<drugs:array<string>,severity:string,description:string>>")
    hits = [F.when(F.array_contains(names, a) & F.array_contains(names, b), F.array(
                F.struct(F.array(*[F.lit(d) for d in sorted((a, b))]).alias("drugs"),
                         F.lit(severity).alias("severity"), F.lit(text).alias("description")))
                ).otherwise(none)
            for a, b, severity, text in rules]
    return F.concat(*hits)


def interactions_by_table(df: DataFrame, record_id: str, names: str, rules: DataFrame) -> DataFrame:
    """The same against a rule table (drug_a, drug_b, severity, description) of any size.

    Each distinct name looks up the rules it opens by an equi join, and the other name is
    looked up among the record's own by another, so pairs within a record are never built and
    no name carries the others along. Rows of one record id are one record.
    """
    held = df.select(F.col(record_id).alias("_record"), F.explode(names).alias("_name")).distinct()
    opened = held.select(F.col("_record").alias(record_id), F.col("_name").alias("drug_a")) \
        .join(rules, "drug_a")
    return (opened.join(held, (F.col(record_id) == F.col("_record"))
                        & (F.col("drug_b") == F.col("_name")), "left_semi")
            .select(record_id, F.least("drug_a", "drug_b").alias("drug_1"),
                    F.greatest("drug_a", "drug_b").alias("drug_2"), "severity", "description"))


def lookup_default(df: DataFrame, table: DataFrame, key: str, table_key: str, value: str,
                   into: str, default: str = "UNKNOWN") -> DataFrame:
    """Left join on a look-up table; keys it does not know get the default. The join
    strategy is left to the optimizer, which knows the table's size."""
    side = table.select(F.col(table_key).alias("_k"), F.col(value).alias("_v"))
    return (df.join(side, F.col(key) == F.col("_k"), "left")
            .withColumn(into, F.coalesce("_v", F.lit(default))).drop("_k", "_v"))


def reference_table(spark, name: str) -> DataFrame:
    """A reference table of fixed size, marked for broadcast."""
    tables = {
        "drug_interactions": (fv.DRUG_INTERACTIONS,
                              "drug_a string, drug_b string, severity string, description string"),
        "vital_ranges": ([(v, *map(float, b)) for v, *b in fv.VITAL_RANGES],
                         "vital string, min double, max double, critical_low double, "
                         "critical_high double"),
        "icd10": (fv.ICD10_DESCRIPTIONS, "code string, description string"),
        "conditions": (fv.CONDITION_KEYWORDS, "keyword string, normalized string"),
    }
    rows, schema = tables[name]
    return F.broadcast(spark.createDataFrame(rows, schema))


def cross_table_dates(left: DataFrame, right: DataFrame, on: Column, start: str,
                      end: str) -> DataFrame:
    """Date order over two joined tables: checked pairs and violations, one row."""
    both = left.join(right, on)
    bad = F.col(end) < F.col(start)
    return both.agg(F.count_if(bad.isNotNull()).alias("checked"),
                    F.count_if(bad).alias("violations"),
                    (F.count_if(bad) == 0).alias("passed"))


def only_validated(df: DataFrame, validated: DataFrame, key: str = "record_id") -> DataFrame:
    return df.join(validated.select(key), key, "left_semi")


def without_flagged(df: DataFrame, flagged: DataFrame, key: str = "record_id") -> DataFrame:
    return df.join(flagged.select(key), key, "left_anti")


def holds_all(values: Column, wanted: Sequence[str]) -> Column:
    """Whether all ``wanted`` values are among the elements of an array; null for a null array.
    Case counts, order and repeats don't, and nothing at all is in every array."""
    return F.size(F.array_except(F.array(*map(F.lit, wanted)).cast("array<string>"), values)) == 0
