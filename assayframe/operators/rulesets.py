"""The three rule sets: flat records, nested records and notes."""

from __future__ import annotations

from ..functions import fixed_values as fv
from . import rules as r

DATE_ORDER = "CustomSql: discharge_date >= admission_date"


def _record_statistics():
    return [r.mean_between("age", 40, 80), r.stddev_max("length_of_stay_days", 15),
            r.row_count(least=100)]


def flat_records() -> list[r.Rule]:
    shares = {"patient_name": 0.98, "mrn": 1.0, "admission_date": 1.0, "discharge_date": 1.0,
              "primary_icd10": 0.95, "systolic_bp": 0.90, "diastolic_bp": 0.90}
    ranges = {"age": (0, 120), "systolic_bp": (50, 250), "diastolic_bp": (30, 150),
              "heart_rate": (20, 250), "temperature_f": (90.0, 108.0),
              "length_of_stay_days": (0, 100)}
    return ([r.completeness(c, t) for c, t in shares.items()]
            + [r.unique("record_id"),
               r.date_order("admission_date", "discharge_date", DATE_ORDER)]
            + [r.value_range(c, low, high) for c, (low, high) in ranges.items()]
            + [r.icd10("primary_icd10")] + _record_statistics())


def nested_records() -> list[r.Rule]:
    shares = {"patient_name": 0.98, "mrn": 1.0, "record_id": 1.0, "admission_date": 1.0,
              "discharge_date": 1.0, "attending_physician": 1.0, "department": 1.0}
    vitals = {"systolic_bp": (50, 250), "heart_rate": (0, 250), "temperature_f": (90.0, 108.0)}
    return ([r.completeness(c, t) for c, t in shares.items()]
            + [r.null_count("diagnoses", 10), r.null_count("medications", 20),
               r.null_count("vitals_at_discharge", 20), r.unique("record_id"),
               r.value_range("age", 0, 120), r.value_range("length_of_stay_days", 0, 100),
               r.values_in("gender", ["M", "F"]),
               r.date_order("admission_date", "discharge_date", DATE_ORDER),
               r.array_not_empty("diagnoses", 0), r.array_not_empty("medications", 10)]
            + [r.nested_range(f"vitals_at_discharge.{v}", low, high)
               for v, (low, high) in vitals.items()]
            + _record_statistics())


def notes() -> list[r.Rule]:
    fields = ["note_text", "record_id", "mrn", "note_type", "author", "date"]
    return ([r.completeness(c, 1.0) for c in fields]
            + [r.unique("record_id"), r.values_in("note_type", fv.NOTE_TYPES),
               r.length_min("note_text", 20),
               r.pattern("date", fv.NOTE_DATE_PATTERN, 0.95),
               r.pattern("mrn", fv.MRN_PATTERN, 0.95),
               r.pattern("author", fv.AUTHOR_PATTERN, 0.90),
               r.row_count(least=100), r.row_count(equal=200)])
