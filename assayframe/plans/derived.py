"""Records and notes derived row by row from the driver tables, in Spark and in SQL.

The driver tables hold no patient records. ``records`` makes one per order and ``notes``
one per document, with faults set by arithmetic on the key, so that every rule and check
has rows that pass and rows that fail at any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import fixed_values as fv
from ..operators.issues import pinned
from .registry import dealt_table, table

AS_OF = "2001-01-01 00:00:00"

DOCTORS = ["Abel", "Brandt", "Chen", "Duval", "Eriksen", "o'Neil"]
DEPARTMENTS = ["North Wing", "South Wing", "Day Unit", "Night Unit", "Outpatients", "Annex 2"]
#: Drugs of the interactions, each pair two places apart, since a record holds drugs of such
#: distances; one of them at two doses; and others of our own. All doses are made up.
_DRUGS = ["Lisinopril", "Warfarin", "Furosemide", "Aspirin", "Metformin", "Placebol",
          "Metformin", "Testamine", "Nullidone", "Fixturol"]
DOSED = [(drug, f"{15 * (i + 1)}mg", ("morning", "noon", "night")[i % 3])
         for i, drug in enumerate(_DRUGS)]
ENDINGS = {
    0: " Assessment: hypertension stable on Lisinopril. Plan: follow-up on 2024-01-15.",
    1: " Contact 555-123-4567 or john.doe@example.com.",
    2: " SSN 123-45-6789, lives at 12 Main Street.",
    3: " Patient is a poor historian and the damn idiot refused aspirin 81 mg.",
    4: " Chief Complaint: chest pain. History: diabetes, COPD. Medications: Metformin, "
       "Warfarin 5 mg. Seen 2024-02-03 and 2024-03-04.",
    7: " drug-seeking behavior, Frequent  flyer, difficult patient, obese and lazy",
}
GARBLED = " ## 44 $$ 9"
#: Ids of blank notes start here, beyond those of records.
BLANK_IDS = 10 ** 12


DIAGNOSES = "array<struct<icd10:string,description:string>>"
MEDICATIONS = "array<struct<name:string,dose:string,frequency:string>>"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def spark_quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _pick(values, index: str) -> str:
    return f"element_at(array({', '.join(map(spark_quoted, values))}), cast({index} + 1 as int))"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_of(dealt_table(spark, sf_dir, "orders"))


def records_of(orders: DataFrame) -> DataFrame:
    """Records of orders, batch or stream."""
    codes = [code for code, _ in fv.ICD10_DESCRIPTIONS]
    names = [name for _, name in fv.ICD10_DESCRIPTIONS]
    first = (f"named_struct('icd10', {_pick(codes, 'k % 10')}, "
             f"'description', {_pick(names, 'k % 10')})")
    second = (f"named_struct('icd10', {_pick(fv.INVALID_CODES, 'k % 5')}, "
              "'description', 'UNKNOWN')")
    meds = ", ".join(
        f"if((k + {5 * i}) % 11 < 2, array(named_struct('name', '{name}', 'dose', "
        f"if(k % 37 = 0, 'one pill', '{dose}'), 'frequency', '{freq}')), "
        f"cast(array() as {MEDICATIONS}))" for i, (name, dose, freq) in enumerate(DOSED))
    keyed = orders.selectExpr(
        "o_orderkey AS k", "o_custkey AS c", "o_orderstatus AS s",
        "cast(o_orderdate AS date) AS day", "o_orderkey % 15 - 1 AS shift")
    # Apart, since with them the projection's code is too long for the JVM to compile.
    return pinned(keyed, {"medications": F.expr(
        f"CASE WHEN k % 103 = 0 THEN NULL WHEN k % 17 = 0 THEN cast(array() AS {MEDICATIONS}) "
        f"ELSE concat({meds}) END")}).selectExpr(
        "k AS record_id",
        "concat('MRN-', lpad(cast(if(k % 97 = 1, k - 1, k) AS string), 6, '0')) AS mrn",
        "CASE k % 50 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'Zoë Łęcka-Ørsted' "
        "ELSE concat('Patient ', c) END AS patient_name",
        "CASE WHEN k % 61 <> 0 THEN c % 130 - 5 END AS age",
        "CASE WHEN s = 'F' THEN 'F' WHEN s = 'O' THEN 'M' WHEN k % 3 = 0 THEN 'U' "
        "WHEN k % 3 = 1 THEN 'X' END AS gender",
        "CASE WHEN k % 71 = 0 THEN 'not a date' WHEN k % 71 = 1 THEN date_format(day, 'yyyy-M-d') "
        "ELSE date_format(day, 'yyyy-MM-dd') END AS admission_date",
        "CASE WHEN k % 83 = 0 THEN NULL WHEN k % 83 = 1 THEN '' ELSE "
        "date_format(date_add(day, cast(shift AS int)), 'yyyy-MM-dd') END AS discharge_date",
        "CASE WHEN k % 89 <> 0 THEN shift + CASE k % 11 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END "
        "END AS length_of_stay_days",
        f"CASE WHEN k % 101 = 0 THEN NULL WHEN k % 6 = 0 THEN cast(array() AS {DIAGNOSES}) "
        f"WHEN k % 4 = 0 THEN array({first}, {second}) ELSE array({first}) END AS diagnoses",
        "medications",
        "CASE WHEN k % 107 <> 0 THEN named_struct("
        "'systolic_bp', CASE WHEN k % 13 <> 0 THEN 40 + k % 260 END, "
        "'diastolic_bp', CASE WHEN k % 13 <> 0 THEN 20 + k % 150 END, 'heart_rate', k % 240 - 10, "
        "'temperature_f', round(88D + (c % 230) / 10D, 1), 'respiratory_rate', 4 + c % 62, "
        "'oxygen_saturation', 45 + k % 60) END AS vitals_at_discharge",
        f"concat('Dr. ', {_pick(DOCTORS, 'k % 6')}) AS attending_physician",
        f"CASE WHEN k % 19 <> 0 THEN {_pick(DEPARTMENTS, 'k % 6')} END AS department",
        "CASE WHEN k % 5 = 0 THEN concat('Inline note for ', k) WHEN k % 5 = 1 THEN '' "
        "END AS clinical_note")


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A note per document, with its whole text, and blank notes beside them: for one document
    in 36, under an id that no record has."""
    endings = " ".join(f"WHEN {rest} THEN concat(text, {spark_quoted(ending)})"
                       for rest, ending in ENDINGS.items())
    own = dealt_table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS i", "doc_id AS seq", "text", "false AS blank")
    blank = table(spark, sf_dir, "documents").where("doc_id % 36 = 5").selectExpr(
        "doc_id AS i", "-1 - doc_id AS seq", "if(doc_id % 2 = 0, '', '   ') AS text",
        "true AS blank")
    return own.unionByName(blank).selectExpr(
        f"if(blank, {BLANK_IDS}L + i, if(i % 7 = 1, i - 1, i)) AS record_id", "seq",
        "if(i % 41 = 0, 'MRN-X', concat('MRN-', lpad(cast(i AS string), 6, '0'))) AS mrn",
        f"if(i % 53 = 0, 'Letter', {_pick(fv.NOTE_TYPES, 'i % 3')}) AS note_type",
        f"CASE WHEN blank THEN text "
        f"ELSE CASE i % 9 WHEN 6 THEN concat(text, repeat({spark_quoted(GARBLED)}, "
        f"cast(length(text) / 4 AS int))) {endings} ELSE text END END AS note_text",
        f"concat('Dr. ', {_pick(DOCTORS, 'i % 6')}) AS author",
        "if(i % 31 = 0, '2024/01/01', concat('2024-01-', lpad(cast(i % 28 + 1 AS string), 2, '0')))"
        " AS date")


# --- the same in SQL ---------------------------------------------------------------------

def listed(values) -> str:
    return "[" + ", ".join(quoted(v) for v in values) + "]"


def _sql_pick(values, index: str) -> str:
    return f"list_extract({listed(values)}, {index} + 1)"


_CODES = listed([c for c, _ in fv.ICD10_DESCRIPTIONS])
_NAMES = listed([n for _, n in fv.ICD10_DESCRIPTIONS])
_FIRST = (f"{{'icd10': list_extract({_CODES}, k % 10 + 1), "
          f"'description': list_extract({_NAMES}, k % 10 + 1)}}")
_SECOND = f"{{'icd10': {_sql_pick(fv.INVALID_CODES, 'k % 5')}, 'description': 'UNKNOWN'}}"
_MEDS = ", ".join(
    f"CASE WHEN (k + {5 * i}) % 11 < 2 THEN {{'name': '{n}', 'dose': CASE WHEN k % 37 = 0 "
    f"THEN 'one pill' ELSE '{d}' END, 'frequency': '{f}'}} END"
    for i, (n, d, f) in enumerate(DOSED))

#: CTE body of ``rec``, the records.
RECORDS_SQL = f"""
SELECT k AS record_id,
  'MRN-' || lpad(CAST(CASE WHEN k % 97 = 1 THEN k - 1 ELSE k END AS VARCHAR), 6, '0') AS mrn,
  CASE k % 50 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'Zoë Łęcka-Ørsted'
    ELSE 'Patient ' || CAST(c AS VARCHAR) END AS patient_name,
  CASE WHEN k % 61 <> 0 THEN c % 130 - 5 END AS age,
  CASE WHEN s = 'F' THEN 'F' WHEN s = 'O' THEN 'M' WHEN k % 3 = 0 THEN 'U'
    WHEN k % 3 = 1 THEN 'X' END AS gender,
  CASE WHEN k % 71 = 0 THEN 'not a date' WHEN k % 71 = 1 THEN strftime(day, '%Y-%-m-%-d')
    ELSE strftime(day, '%Y-%m-%d') END AS admission_date,
  CASE WHEN k % 83 = 0 THEN NULL WHEN k % 83 = 1 THEN ''
    ELSE strftime(day + CAST(shift AS INTEGER), '%Y-%m-%d') END AS discharge_date,
  CASE WHEN k % 89 <> 0 THEN shift + CASE k % 11 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END
    END AS length_of_stay_days,
  CASE WHEN k % 101 = 0 THEN NULL WHEN k % 6 = 0 THEN [] WHEN k % 4 = 0 THEN [{_FIRST}, {_SECOND}]
    ELSE [{_FIRST}] END AS diagnoses,
  CASE WHEN k % 103 = 0 THEN NULL WHEN k % 17 = 0 THEN []
    ELSE list_filter([{_MEDS}], lambda m: m IS NOT NULL) END AS medications,
  CASE WHEN k % 107 <> 0 THEN {{
    'systolic_bp': CASE WHEN k % 13 <> 0 THEN 40 + k % 260 END,
    'diastolic_bp': CASE WHEN k % 13 <> 0 THEN 20 + k % 150 END,
    'heart_rate': k % 240 - 10,
    'temperature_f': round(88.0::DOUBLE + (c % 230) / 10.0::DOUBLE, 1),
    'respiratory_rate': 4 + c % 62, 'oxygen_saturation': 45 + k % 60}} END AS vitals_at_discharge,
  'Dr. ' || {_sql_pick(DOCTORS, 'k % 6')} AS attending_physician,
  CASE WHEN k % 19 <> 0 THEN {_sql_pick(DEPARTMENTS, 'k % 6')} END AS department,
  CASE WHEN k % 5 = 0 THEN 'Inline note for ' || CAST(k AS VARCHAR)
    WHEN k % 5 = 1 THEN '' END AS clinical_note
FROM (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s,
        CAST(o_orderdate AS DATE) AS day, o_orderkey % 15 - 1 AS shift FROM orders)
"""

#: CTE body of ``nts``, the notes.
NOTES_SQL = f"""
SELECT CASE WHEN blank THEN {BLANK_IDS} + i WHEN i % 7 = 1 THEN i - 1 ELSE i END AS record_id, seq,
  CASE WHEN i % 41 = 0 THEN 'MRN-X' ELSE 'MRN-' || lpad(CAST(i AS VARCHAR), 6, '0') END AS mrn,
  CASE WHEN i % 53 = 0 THEN 'Letter' ELSE {_sql_pick(fv.NOTE_TYPES, 'i % 3')} END AS note_type,
  CASE WHEN blank THEN text
    WHEN i % 9 = 6 THEN text || repeat({quoted(GARBLED)}, CAST(length(text) // 4 AS BIGINT))
    {' '.join(f"WHEN i % 9 = {r} THEN text || {quoted(e)}" for r, e in ENDINGS.items())}
    ELSE text END AS note_text,
  'Dr. ' || {_sql_pick(DOCTORS, 'i % 6')} AS author,
  CASE WHEN i % 31 = 0 THEN '2024/01/01'
    ELSE '2024-01-' || lpad(CAST(i % 28 + 1 AS VARCHAR), 2, '0') END AS date
FROM (SELECT doc_id AS i, doc_id AS seq, text, false AS blank FROM documents
  UNION ALL SELECT doc_id, -1 - doc_id, CASE WHEN doc_id % 2 = 0 THEN '' ELSE '   ' END, true
  FROM documents WHERE doc_id % 36 = 5)
"""

#: CTE body of ``flat``, the flat form of ``rec``.
FLAT_SQL = """
SELECT record_id, mrn, patient_name, age, gender, admission_date, discharge_date,
  length_of_stay_days,
  coalesce(list_extract(diagnoses, 1).icd10, '') AS primary_icd10,
  coalesce(list_extract(diagnoses, 1).description, '') AS primary_diagnosis,
  CAST(coalesce(len(medications), 0) AS BIGINT) AS num_medications,
  vitals_at_discharge.systolic_bp AS systolic_bp, vitals_at_discharge.diastolic_bp AS diastolic_bp,
  vitals_at_discharge.heart_rate AS heart_rate,
  vitals_at_discharge.temperature_f AS temperature_f, department, attending_physician
FROM rec
"""

#: CTE body of ``joined``: records with the last note of their id, else the inline one.
JOINED_SQL = """
SELECT rec.*, coalesce(nullif(n.note_text, ''), rec.clinical_note, '') AS note
FROM rec LEFT JOIN (SELECT record_id, arg_max(note_text, seq) AS note_text FROM nts
                    GROUP BY record_id) n
  ON CAST(rec.record_id AS VARCHAR) = CAST(n.record_id AS VARCHAR)
"""

_CTES = {"rec": RECORDS_SQL, "nts": NOTES_SQL, "flat": FLAT_SQL, "joined": JOINED_SQL}


def with_ctes(names: str, body: str, **more: str) -> str:
    """``WITH`` the named CTEs (and further ones) before a query."""
    parts = {**{n: _CTES[n] for n in names.split()}, **more}
    return "WITH " + ", ".join(f"{n} AS MATERIALIZED ({sql})" for n, sql in parts.items()) + body
