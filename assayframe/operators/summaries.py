"""Batch summaries over validated records (frames with ``_validation``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed_values as fv
from .issues import unfold

ISSUES = "_validation.issues"


def _percent(part, whole):
    return part / F.greatest(whole, F.lit(1)) * 100


def validation_summary(df: DataFrame) -> DataFrame:
    """Records by status, quality score and pass rate; one row."""
    status = F.col("_validation.status")
    total, passed = F.count("*"), F.count_if(status == "PASS")
    return df.agg(
        total.alias("total"), passed.alias("passed"),
        F.count_if(status == "FAIL").alias("failed"),
        F.count_if(status == "WARNING").alias("warnings"),
        F.round(_percent(passed, total), 1).alias("quality_score"),
        _percent(passed, total).alias("pass_rate"))


def errors_by_type(df: DataFrame) -> DataFrame:
    """Issues (not records) per type, warnings included, most frequent first."""
    return (df.select(unfold(F.col(ISSUES))).where("type is not null").groupBy("type")
            .agg(F.count("*").alias("issues")).orderBy(F.desc("issues"), "type"))


def gate_summary(df: DataFrame) -> DataFrame:
    """Gate counters and the average relevance, without exploding the issues."""
    issues = F.col(ISSUES)

    def occurrences(test):
        return F.coalesce(F.sum(F.size(F.filter(issues, test))), F.lit(0))

    def of_kind(kind):
        return occurrences(lambda i: i["type"] == kind)

    counters = [of_kind(kind).alias(name) for name, kind in fv.GATE_COUNTERS]
    return df.agg(
        F.count("*").alias("records_checked"), *counters,
        occurrences(lambda i: i["type"].startswith("RA_")).alias("total_ra_issues"),
        F.coalesce(F.round(F.avg("_validation.relevance_score"), 1), F.lit(0.0))
        .alias("avg_clinical_relevance_score"))


def entity_totals(df: DataFrame, entities: str = "entities") -> DataFrame:
    """Medications and conditions found, and records with personal data."""
    e = F.col(entities)
    return df.agg(
        F.count("*").alias("records"),
        F.coalesce(F.sum(F.size(e["medications"]) + F.size(e["conditions"])), F.lit(0))
        .alias("total_entities"),
        F.count_if(e["phi_detected"]).alias("phi_records"))
