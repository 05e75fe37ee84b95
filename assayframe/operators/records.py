"""Nested records to flat ones, and the first records by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

FLAT_VITALS = ["systolic_bp", "diastolic_bp", "heart_rate", "temperature_f"]


def flatten(df: DataFrame) -> DataFrame:
    """First diagnosis (blank for none), number of medications and four vitals as columns."""
    first = F.get("diagnoses", F.lit(0))
    return df.select(
        "record_id", "mrn", "patient_name", "age", "gender", "admission_date", "discharge_date",
        "length_of_stay_days",
        F.coalesce(first["icd10"], F.lit("")).alias("primary_icd10"),
        F.coalesce(first["description"], F.lit("")).alias("primary_diagnosis"),
        F.coalesce(F.size("medications"), F.lit(0)).cast("long").alias("num_medications"),
        *[F.col(f"vitals_at_discharge.{v}").alias(v) for v in FLAT_VITALS],
        "department", "attending_physician")


def first_records(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    """The ``n`` records with the smallest keys (a top-k, not a full sort)."""
    return df.orderBy(key).limit(n)
