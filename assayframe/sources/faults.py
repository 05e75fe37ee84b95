"""Seeded faults, to test that rules and checks see them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Fault:
    """What to set in a row, by column or dotted struct field."""

    name: str
    changes: dict[str, Column]


def _draws(key: Column, seed: int) -> tuple[Column, Column]:
    """Two whole numbers below 2**32, a function of key and seed alone."""
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))
    return tuple(F.conv(F.substring(digest, at, 8), 16, 10).cast("long") for at in (1, 9))


def inject_faults(df: DataFrame, key: str, faults: Sequence[Fault], rate: float = 0.12,
                  seed: int = 42) -> DataFrame:
    """Gives a share ``rate`` of the rows one fault each, named in ``fault``.

    Which rows, and which fault, depend on key and seed only, not on how the rows are
    split; copies of a key get the same fault.
    """
    chance, pick = _draws(F.col(key), seed)
    names = F.array(*[F.lit(f.name) for f in faults])
    out = df.withColumn("fault", F.when(chance < int(rate * 2 ** 32), F.get(
        names, (pick % len(faults)).cast("int"))))
    # One CASE per column or struct field, so that expressions grow with the faults only.
    cases: dict[str, dict[str, Column]] = {}
    for fault in faults:
        for path, value in fault.changes.items():
            cases.setdefault(path, {})[fault.name] = value
    changed: dict[str, Column] = {}
    for path, values in cases.items():
        top, _, inner = path.partition(".")
        dtype = df.schema[top].dataType
        case = None
        for name, value in values.items():
            test = F.col("fault") == name
            new = value.cast(dtype[inner].dataType if inner else dtype)
            case = F.when(test, new) if case is None else case.when(test, new)
        case = case.otherwise(F.col(path))
        changed[top] = changed.get(top, F.col(top)).withField(inner, case) if inner else case
    return out.withColumns(changed)


def record_faults(as_of) -> list[Fault]:
    """The faults of nested records: of the record, its vital signs and its codes."""
    codes = "array<struct<icd10:string,description:string>>"

    def coded(code):
        return F.concat(F.col("diagnoses"), F.array(F.struct(
            F.lit(code).alias("icd10"), F.lit("UNKNOWN").alias("description"))).cast(codes))

    vital = "vitals_at_discharge"
    return [
        Fault("missing_name", {"patient_name": F.lit("")}),
        Fault("future_date", {"discharge_date": F.date_format(
            F.date_add(F.lit(as_of).cast("date"), 30), "yyyy-MM-dd")}),
        Fault("negative_age", {"age": F.lit(-5)}),
        Fault("empty_meds", {"medications": F.array()}),
        Fault("duplicate_mrn", {"mrn": F.lit("MRN-000001")}),
        Fault("encoding", {"patient_name": F.lit("Zoë Łęcka-Ørsted"),
                           "department": F.lit("Día y Noche")}),
        Fault("impossible_bp", {f"{vital}.systolic_bp": 300 + F.col("record_id") % 201}),
        Fault("extreme_temp", {f"{vital}.temperature_f": 110.0 + F.col("record_id") % 11}),
        Fault("negative_hr", {f"{vital}.heart_rate": -1 - F.col("record_id") % 50}),
        Fault("missing_bp", {f"{vital}.systolic_bp": F.lit(None),
                             f"{vital}.diastolic_bp": F.lit(None)}),
        Fault("bad_code", {"diagnoses": coded("ZZ99.9")}),
        Fault("blank_code", {"diagnoses": coded("")}),
    ]
