"""Record checks on edge records against a row-wise statement, and strict reading."""

import itertools
import json
import re
from datetime import datetime

from pyspark.sql import functions as F

from assayframe.functions import fixed_values as fv
from assayframe.operators import joins, routing, summaries, validation as v
from assayframe.operators.issues import found, issue
from assayframe.sources import faults, readers, writers

AS_OF = "2024-06-01 00:00:00"
GOOD = {"record_id": 1, "mrn": "MRN-000001", "patient_name": "A B", "age": 50, "gender": "F",
        "admission_date": "2024-01-01", "discharge_date": "2024-01-05", "length_of_stay_days": 4,
        "diagnoses": [("I10", "x")], "medications": [("Aspirin", "81mg", "QD")],
        "vitals_at_discharge": (120, 80, 70, 98.6, 16, 97), "attending_physician": "Dr. X",
        "department": "D", "clinical_note": "note"}
CHANGES = [
    {}, {"mrn": ""}, {"patient_name": None}, {"age": None}, {"age": -5}, {"age": 121}, {"age": 120},
    {"gender": "X"}, {"gender": ""}, {"gender": None}, {"admission_date": "2024-1-1"},
    {"admission_date": "2024-02-30"}, {"admission_date": None}, {"discharge_date": "2023-12-30"},
    {"discharge_date": "2024-07-01"}, {"length_of_stay_days": 5}, {"length_of_stay_days": 6},
    {"length_of_stay_days": None}, {"diagnoses": None}, {"diagnoses": []},
    {"diagnoses": [("ZZ99.9", ""), ("X00", ""), ("", ""), (None, ""), ("E11.1234", "")]},
    {"medications": None}, {"vitals_at_discharge": None},
    {"medications": [("Metformin", "500mg", ""), ("Metformin", "1 g", ""),
                     ("Furosemide", "5 units", ""), ("Lisinopril", "one pill", ""),
                     ("Warfarin", "", ""), ("Aspirin", None, ""), ("aspirin", "81 MG", "")]},
    {"vitals_at_discharge": (300, 30, -4, 114.1, None, 100)},
    {"vitals_at_discharge": (60, 151, 40, float("nan"), 5, 88)}, {"clinical_note": ""},
]


def row_wise(rec, level):
    """(type, field, severity) in order, from a plain statement of the checks."""
    out = [("MISSING_REQUIRED_FIELD", f, "ERROR") for f in fv.REQUIRED_FIELDS
           if rec[f] in (None, "", [])]
    if rec["age"] is not None and not 0 <= rec["age"] <= 120:
        out.append(("INVALID_AGE", "age", "ERROR"))
    if (rec["gender"] or "") not in fv.GENDERS:
        out.append(("INVALID_GENDER", "gender", "WARNING"))
    try:
        a, d = (datetime.strptime(rec[k] or "", "%Y-%m-%d")
                for k in ("admission_date", "discharge_date"))
        if d < a:
            out.append(("DATE_INCONSISTENCY", "discharge_date", "ERROR"))
        if d > datetime.fromisoformat(AS_OF):
            out.append(("FUTURE_DATE", "discharge_date", "ERROR"))
        los = rec["length_of_stay_days"]
        if los is not None and abs((d - a).days - los) > 1:
            out.append(("LOS_MISMATCH", "length_of_stay_days", "WARNING"))
    except ValueError:
        out.append(("INVALID_DATE_FORMAT", None, "ERROR"))
    meds = rec["medications"] or []
    if level in ("full", "strict"):
        out += [("INVALID_ICD10", "diagnoses.icd10", "ERROR") for c, _ in rec["diagnoses"] or []
                if c and not re.match(fv.ICD10_RECORD_PATTERN, c)]
        for (name, lo, hi, c_lo, c_hi), x in zip(fv.VITAL_RANGES,
                                                 rec["vitals_at_discharge"] or []):
            if x is not None and (x < lo or x > hi):
                out.append(("VITAL_OUT_OF_RANGE", f"vitals.{name}", "ERROR"))
            elif x is not None and (x <= c_lo or x >= c_hi):
                out.append(("VITAL_CRITICAL", f"vitals.{name}", "WARNING"))
        names = {m[0] for m in meds}
        out += [("DRUG_INTERACTION", "medications", "ERROR" if s == "HIGH" else "WARNING")
                for a, b, s, _ in fv.DRUG_INTERACTIONS if {a, b} <= names]
    if level == "strict":
        if not rec["clinical_note"]:
            out.append(("MISSING_CLINICAL_NOTE", "clinical_note", "WARNING"))
        out += [("INVALID_DOSAGE_FORMAT", "medications.dose", "WARNING") for _, d, _ in meds
                if d and not re.match(fv.DOSE_PATTERN, d, re.I)]
    return out


def records():
    single = [{**GOOD, **c} for c in CHANGES]
    double = [{**GOOD, **a, **b} for a, b in itertools.islice(
        itertools.combinations(CHANGES, 2), 0, None, 5)]
    return [{**rec, "record_id": i} for i, rec in enumerate(single + double)]


def frame(spark, recs):
    order = [f.name for f in spark.createDataFrame([], readers.RECORD_SCHEMA).schema.fields]
    return spark.createDataFrame([tuple(r[c] for c in order) for r in recs],
                                 readers.RECORD_SCHEMA)


def test_checks_equal_the_row_wise_statement(spark):
    recs = records()
    df = frame(spark, recs).repartition(5)
    for level in ("basic", "full", "strict", "whatever"):
        got = {r["record_id"]: r["_validation"] for r in v.validate(df, level, AS_OF).collect()}
        for rec in recs:
            want = row_wise(rec, level)
            mine = got[rec["record_id"]]
            assert [(i["type"], i["field"], i["severity"]) for i in mine["issues"]] == want, rec
            errors = sum(s == "ERROR" for _, _, s in want)
            assert mine["error_count"] == errors and mine["warning_count"] == len(want) - errors
            assert mine["status"] == ("FAIL" if errors else "WARNING" if want else "PASS")


def test_messages(spark):
    rec = {**GOOD, "age": -5, "vitals_at_discharge": (461, 80, 70, 98.6, 16, 97),
           "medications": [("Warfarin", "5mg", ""), ("Aspirin", "81mg", "")]}
    issues = v.validate(frame(spark, [rec]), "full", AS_OF).first()["_validation"]["issues"]
    assert [i["message"] for i in issues] == [
        "Age -5 is outside valid range [0, 120]",
        "systolic_bp=461.0 outside physiological range [60, 250]",
        "Drug interaction (HIGH): Aspirin + Warfarin — Increased bleeding risk with concurrent "
        "anticoagulant and antiplatelet therapy"]
    assert issues[2]["drugs"] == ["Aspirin", "Warfarin"]


def test_empty_frame_and_summaries(spark):
    df = v.validate(frame(spark, []), "full", AS_OF, "clinical_note")
    one = summaries.validation_summary(df).first()
    assert (one["total"], one["quality_score"]) == (0, 0.0)
    assert summaries.gate_summary(df).first()["avg_clinical_relevance_score"] == 0.0
    assert summaries.errors_by_type(df).count() == 0


def test_split(spark):
    df = v.validate(frame(spark, records()[:27]), "basic", AS_OF)
    kept = {r["record_id"] for r in routing.validated(df).collect()}
    flagged = {r["record_id"]: r["status"] for r in routing.flagged(df).collect()}
    assert kept & set(flagged) == {k for k, s in flagged.items() if s == "WARNING"}
    assert "_validation" not in routing.strip_validation(df).columns


def test_strict_reader_tells_text_null_and_absent(spark, tmp_path):
    items = [{**{k: GOOD[k] for k in ("mrn", "patient_name", "admission_date", "discharge_date")},
              "diagnoses": [{"icd10": "I10", "description": ""}], "record_id": i, **extra}
             for i, extra in enumerate([
                 {"age": "45", "gender": "F"}, {"age": 45, "gender": None}, {"age": 45.5},
                 {"age": None, "gender": "F", "vitals_at_discharge": {"heart_rate": "fast",
                                                                      "systolic_bp": "120"}}])]
    (tmp_path / "a.json").write_text(json.dumps(items, indent=1))
    df = readers.read_json_strict(spark, str(tmp_path / "a.json"))
    got = {r["record_id"]: [(i["type"], i["value"]) for i in r["_validation"]["issues"]]
           for r in v.validate(df, "full", AS_OF).collect()}
    assert got == {
        0: [("INVALID_AGE", "45")],
        1: [("MISSING_REQUIRED_FIELD", None), ("INVALID_GENDER", None)],
        2: [("MISSING_REQUIRED_FIELD", None)],
        3: [("MISSING_REQUIRED_FIELD", None), ("INVALID_VITAL_VALUE", "fast")]}


def test_typed_csv(spark, tmp_path):
    (tmp_path / "r.csv").write_text("record_id,age,temperature_f,department\n"
                                    "1,45,98.6,\n2,,x,A\n3,3.0,-1,\"B, C\"\n")
    rows = readers.read_csv_typed(spark, str(tmp_path / "r.csv")).orderBy("record_id").collect()
    assert [tuple(r) for r in rows] == [(1, 45, 98.6, ""), (2, None, None, "A"),
                                        (3, None, -1.0, "B, C")]


def test_notes_last_wins_and_inline_fallback(spark):
    recs = spark.createDataFrame([(1, "in"), (2, "in"), (3, None), (None, "n")],
                                 "record_id bigint, clinical_note string")
    notes = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "x", 1), (2, "", 2)] +
                                  [(9, f"n{i}", i) for i in range(200)],
                                  "record_id bigint, note_text string, seq int").repartition(4)
    got = {r["record_id"]: r["note"] for r in joins.join_notes(recs, notes, "seq").collect()}
    assert got == {1: "new", 2: "in", 3: "", None: "n"}
    typed = joins.join_notes_typed(recs, notes, "seq").collect()
    assert {r["record_id"]: r["note"] for r in typed} == {1: "new", 2: "", 3: "", None: ""}


def test_interaction_table_equals_expression(spark):
    names = spark.createDataFrame([(1, ["Warfarin", "Aspirin", "Aspirin"]), (2, []), (3, None),
                                   (4, ["Furosemide", "Metformin", "Lisinopril"])],
                                  "record_id int, names array<string>")
    table = joins.reference_table(spark, "drug_interactions")
    a = {(r["record_id"], r["severity"]) for r in joins.interactions_by_table(
        names, "record_id", "names", table).collect()}
    b = {(r["record_id"], s) for r in names.select("record_id", joins.interactions_of(
        F.col("names"))["severity"].alias("s")).collect() for s in r["s"] or []}
    assert a == b == {(1, "HIGH"), (4, "MODERATE"), (4, "LOW")}


def test_user_rule(spark):
    def short_name(df):
        return found(("length(patient_name) < 5", issue("SHORT_NAME", "patient_name", "WARNING",
                                                        "'short'")))

    out = v.validate(frame(spark, [GOOD]), "basic", AS_OF, extra=[short_name]).first()
    assert out["_validation"]["status"] == "WARNING"


def test_faults_do_not_depend_on_partitions_and_are_found(spark):
    recs = [{**GOOD, "record_id": i, "mrn": f"MRN-{i:06d}"} for i in range(400)]
    df = frame(spark, recs)
    chosen = faults.record_faults("2024-06-01")
    one = faults.inject_faults(df.coalesce(1), "record_id", chosen, 0.3)
    seven = faults.inject_faults(df.repartition(7), "record_id", chosen, 0.3)
    a = {r["record_id"]: r["fault"] for r in one.collect()}
    assert a == {r["record_id"]: r["fault"] for r in seven.collect()}
    assert 60 < sum(f is not None for f in a.values()) < 180
    assert set(a.values()) == {None, *(f.name for f in chosen)}
    expected = {"missing_name": "MISSING_REQUIRED_FIELD", "future_date": "FUTURE_DATE",
                "negative_age": "INVALID_AGE", "impossible_bp": "VITAL_OUT_OF_RANGE",
                "extreme_temp": "VITAL_OUT_OF_RANGE", "negative_hr": "VITAL_OUT_OF_RANGE",
                "bad_code": "INVALID_ICD10"}
    for row in v.validate(seven, "full", AS_OF).collect():
        types = {i["type"] for i in row["_validation"]["issues"]}
        if row["fault"] in expected:
            assert expected[row["fault"]] in types
        elif row["fault"] in (None, "encoding", "blank_code", "empty_meds"):
            assert types <= {"VITAL_CRITICAL"}


def test_outputs(spark, tmp_path):
    df = v.validate(frame(spark, records()[:27]), "full", AS_OF, "clinical_note")
    kept = writers.write_validation(df, str(tmp_path / "out"))
    clean = spark.read.parquet(str(tmp_path / "out/clean")).count()
    flagged = spark.read.parquet(str(tmp_path / "out/flagged")).count()
    assert kept.count() == 27 and clean + flagged >= 27
