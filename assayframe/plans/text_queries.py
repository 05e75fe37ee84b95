"""Queries: text gates, relevance, redaction, entities, prompts and payloads."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..operators import entities as en, gates, payloads, summaries, validation as v
from ..operators.issues import unfold
from ..operators.joins import join_notes, join_notes_typed
from . import derived
from .derived import AS_OF, quoted, with_ctes
from .registry import dealt_table, query, table
from .validation_queries import FULL, status_sql

# --- signals of a note in SQL ----------------------------------------------------------------
# RE2's \b and \w know ASCII only, so letters beyond ASCII are first read as 'q', which
# changes neither word bounds nor lengths.

ASCII = "regexp_replace(note, '[^\\x00-\\x7F]', 'q', 'g')"


def split_words(x):
    return f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> '')"


def _all(pattern):
    return f"regexp_extract_all(t, {quoted('(?i)' + pattern)}, 1)"


_PHI = " || ".join(
    f"CASE WHEN regexp_matches(t, {quoted(p)}) THEN ['{n}'] ELSE [] END" for n, p in [
        ("SSN", fv.SSN_PATTERN), ("email", fv.EMAIL_PATTERN), ("phone_number", fv.PHONE_PATTERN),
        ("street_address", "(?i)" + fv.ADDRESS_PATTERN)])

SIGNALS_SQL = f"""
SELECT record_id, note, len({split_words('note')}) AS words, length(note) AS chars,
  length(regexp_replace(note, '[^\\p{{L}}\\s]', '', 'g')) AS letters,
  {_all(fv.PROFANITY_PATTERN)} AS profanity, {_PHI} AS phi,
  len(list_distinct({_all(fv.TERM_PATTERN)})) AS terms, {_all(fv.BIAS_PATTERN)} AS bias,
  len({_all(fv.SECTION_PATTERN)}) AS sections,
  len(list_filter(parts, lambda s: len({split_words('s')}) >= 3)) AS full_sentences,
  len(parts) AS sentences
FROM (SELECT record_id, note, {ASCII} AS t,
  regexp_split_to_array(trim(note, E' \\n\\t\\r'), '[.!?]+') AS parts FROM src)
"""


def gate_sql(kind, severity, value, where):
    if kind != "RA_EMPTY_NOTE":
        where = f"words > 0 AND {where}"
    return (f"SELECT record_id, '{kind}' AS type, '{severity}' AS severity, {value} AS value "
            f"FROM sig WHERE {where}")


NONE = "CAST(NULL AS VARCHAR)"


def first3(x):
    return f"array_to_string({x}[1:3], ', ')"


GATES = {
    "g_empty_note": gate_sql("RA_EMPTY_NOTE", "WARNING", NONE, "words = 0"),
    "g_profanity": gate_sql("RA_PROFANITY", "ERROR", first3("profanity"), "len(profanity) > 0"),
    "g_phi": gate_sql("RA_PHI_EXPOSURE", "WARNING", "array_to_string(phi, ', ')", "len(phi) > 0"),
    "g_too_short": gate_sql("RA_LOW_RELEVANCE", "WARNING", "CAST(words AS VARCHAR)",
                            "words < 20"),
    "g_no_terms": gate_sql("RA_LOW_RELEVANCE", "WARNING", NONE, "terms = 0"),
    "g_garbled": gate_sql("RA_GARBLED_TEXT", "WARNING",
                          "CAST(round(letters / chars::DOUBLE, 3) AS VARCHAR)",
                          "letters / chars::DOUBLE < 0.60"),
    "g_bias": gate_sql("RA_BIAS_INDICATOR", "WARNING", first3("bias"), "len(bias) > 0"),
    "g_incoherent": gate_sql("RA_LOW_COHERENCE", "WARNING", NONE, "full_sentences = 0"),
    "g_unstructured": gate_sql("RA_UNSTRUCTURED_NOTE", "WARNING", NONE,
                               "sections = 0 AND words >= 40"),
}
SCORE_SQL = """CASE WHEN words = 0 THEN 0.0::DOUBLE ELSE round(least(100.0::DOUBLE,
  least(words / 50.0::DOUBLE, 1.0) * 30.0 + least(terms / words::DOUBLE * 10, 1.0) * 30.0
  + least(sections / 3.0::DOUBLE, 1.0) * 20.0 + full_sentences / sentences::DOUBLE * 20.0), 1) END"""
NOTE_SRC = "SELECT seq AS record_id, coalesce(note_text, '') AS note FROM nts"
JOINED_SRC = "SELECT record_id, note FROM joined"


def over_notes(body, **more):
    return with_ctes("nts", body, src=NOTE_SRC, sig=SIGNALS_SQL, **more)


def over_records(body, **more):
    return with_ctes("rec nts joined", body, src=JOINED_SRC, sig=SIGNALS_SQL, **more)


def noted(spark, sf_dir):
    """Every note as a record of its own."""
    n = derived.notes(spark, sf_dir)
    return n.select(F.col("seq").alias("record_id"), F.col("note_text").alias("note"))


def gated(spark, sf_dir):
    return gates.with_gates(noted(spark, sf_dir), "note", "record_id")


def _gate(name, kind, test=None):
    def run(spark, sf_dir):
        out = gated(spark, sf_dir).select("record_id", unfold(F.col("gate_issues"))).where(
            F.col("type") == kind)
        if test is not None:
            out = out.where(test)
        return out.select("record_id", "type", "severity", "value")

    query(name, over_notes(GATES[name]))(run)


_gate("g_empty_note", "RA_EMPTY_NOTE")
_gate("g_profanity", "RA_PROFANITY")
_gate("g_phi", "RA_PHI_EXPOSURE")
_gate("g_too_short", "RA_LOW_RELEVANCE", "value is not null")
_gate("g_no_terms", "RA_LOW_RELEVANCE", "value is null")
_gate("g_garbled", "RA_GARBLED_TEXT")
_gate("g_bias", "RA_BIAS_INDICATOR")
_gate("g_incoherent", "RA_LOW_COHERENCE")
_gate("g_unstructured", "RA_UNSTRUCTURED_NOTE")


@query("relevance_score", over_notes(f"SELECT record_id, {SCORE_SQL} AS score FROM sig"))
def _(spark, sf_dir):
    return gates.with_relevance(noted(spark, sf_dir), "note").select(
        "record_id", F.col("relevance_score").alias("score"))


#: A vocabulary of the documents themselves, for the gates that take a word list.
GENERIC = gates.GatePatterns(
    terms=r"\b(thing|than|erth|anea|thin)\b", sections=r"\b(The|On|Is)[\s:—]",
    bias=r"\b(of\s+the|to\s+be)\b", profanity=r"\b(thou|then)\b")
_GENERIC_SQL = SIGNALS_SQL
for _default, _own in [(fv.TERM_PATTERN, GENERIC.terms), (fv.SECTION_PATTERN, GENERIC.sections),
                       (fv.BIAS_PATTERN, GENERIC.bias), (fv.PROFANITY_PATTERN, GENERIC.profanity)]:
    _GENERIC_SQL = _GENERIC_SQL.replace(_default.replace("'", "''"), _own)


@query("gates_generic_terms", with_ctes("", f"""
SELECT record_id, {SCORE_SQL} AS score, len(profanity) > 0 AS blocked,
  (words > 0 AND len(bias) > 0) AS biased FROM sig""",
    src="SELECT doc_id AS record_id, text AS note FROM documents", sig=_GENERIC_SQL))
def _(spark, sf_dir):
    out = gates.with_gates(dealt_table(spark, sf_dir, "documents"), "text", "doc_id", GENERIC)

    def has(kind):
        return F.exists("gate_issues", lambda i: i["type"] == kind)

    return out.select(F.col("doc_id").alias("record_id"), F.col("relevance_score").alias("score"),
                      has("RA_PROFANITY").alias("blocked"), has("RA_BIAS_INDICATOR").alias("biased"))


@query("fm_gate", over_notes("""
SELECT record_id, CASE WHEN words > 0 AND len(profanity) > 0 THEN 'blocked'
  WHEN words > 0 AND len(phi) > 0 THEN 'deidentify' ELSE 'ready' END AS route FROM sig"""))
def _(spark, sf_dir):
    return gates.with_route(noted(spark, sf_dir), "note").select("record_id", "route")


_REDACTED = "note"
for _n, _p in [("SSN", fv.SSN_PATTERN), ("EMAIL", fv.EMAIL_PATTERN),
               ("PHONE_NUMBER", fv.PHONE_PATTERN), ("STREET_ADDRESS", "(?i)" + fv.ADDRESS_PATTERN),
               ("DATE", fv.DATE_ENTITY_PATTERN)]:
    _REDACTED = f"regexp_replace({_REDACTED}, {quoted(_p)}, '[{_n}]', 'g')"


@query("redact_phi", with_ctes("nts", f"SELECT record_id, md5({_REDACTED}) AS redacted, "
                                      f"length({_REDACTED}) AS size FROM src", src=NOTE_SRC))
def _(spark, sf_dir):
    redacted = gates.redact_phi(F.col("note"))
    return noted(spark, sf_dir).select("record_id", redacted.alias("r")).select(
        "record_id", F.md5("r").alias("redacted"), F.length("r").alias("size"))


@query("distinct_terms", over_notes("SELECT record_id, terms FROM sig"))
def _(spark, sf_dir):
    found = gates.find_words(F.col("note"), fv.TERM_PATTERN)
    return noted(spark, sf_dir).select("record_id", F.size(F.array_distinct(found)).alias("terms"))


@query("first_k_matches", over_notes(
    f"SELECT record_id, {first3('bias')} AS found FROM sig WHERE len(bias) > 0"))
def _(spark, sf_dir):
    return noted(spark, sf_dir).select(
        "record_id", en.first_matches(F.col("note"), fv.BIAS_PATTERN, 3, 1).alias("m")).where(
        F.size("m") > 0).select("record_id", F.array_join("m", ", ").alias("found"))


# --- validation with notes: summaries ------------------------------------------------------------

ALL_ISSUES = (" UNION ALL ".join(f"SELECT record_id, type, severity FROM ({s})" for s in FULL)
              + " UNION ALL "
              + " UNION ALL ".join(f"SELECT record_id, type, severity FROM ({s})"
                                   for s in GATES.values()))
STATUS = status_sql(["SELECT record_id, severity FROM iss"])


def full_sql(body):
    return over_records(body, iss=ALL_ISSUES, st=STATUS)


def joined_frame(spark, sf_dir, frames=None):
    """``frames``: records and notes that are there already."""
    records, notes = frames or (derived.records(spark, sf_dir), derived.notes(spark, sf_dir))
    return join_notes(records, notes, "seq")


def full_frame(spark, sf_dir, frames=None, detail=True):
    return v.validate(joined_frame(spark, sf_dir, frames), "full", AS_OF, "note", detail=detail)


@query("validation_summary", full_sql("""
SELECT count(*) AS total, count(*) FILTER (status = 'PASS') AS passed,
  count(*) FILTER (status = 'FAIL') AS failed, count(*) FILTER (status = 'WARNING') AS warnings,
  round(count(*) FILTER (status = 'PASS') * 100.0::DOUBLE / greatest(count(*), 1), 1)
    AS quality_score FROM st"""))
def _(spark, sf_dir):
    return summaries.validation_summary(full_frame(spark, sf_dir, detail=False)).drop("pass_rate")


@query("quality_score", full_sql("""
SELECT round(count(*) FILTER (status = 'PASS') * 100.0::DOUBLE / greatest(count(*), 1), 1)
  AS quality_score FROM st"""))
def _(spark, sf_dir):
    return summaries.validation_summary(full_frame(spark, sf_dir, detail=False)).select("quality_score")


@query("pass_rate", with_ctes("rec", """
SELECT gender, round(count(*) FILTER (status = 'PASS') * 100.0::DOUBLE / greatest(count(*), 1), 6)
  AS pass_rate FROM rec JOIN st USING (record_id) GROUP BY gender""", st=status_sql(FULL)))
def _(spark, sf_dir):
    df = v.validate(derived.records(spark, sf_dir), "full", AS_OF, detail=False)
    passed = F.count_if(F.col("_validation.status") == "PASS")
    return df.groupBy("gender").agg(F.round(
        passed * 100.0 / F.greatest(F.count("*"), F.lit(1)), 6).alias("pass_rate"))


@query("errors_by_type", full_sql(
    "SELECT type, count(*) AS issues FROM iss GROUP BY type"))
def _(spark, sf_dir):
    return summaries.errors_by_type(full_frame(spark, sf_dir, detail=False))


@query("gate_summary", full_sql(
    "SELECT (SELECT count(*) FROM rec) AS records_checked, "
    + ", ".join(f"count(*) FILTER (type = '{k}') AS {n}" for n, k in fv.GATE_COUNTERS)
    + ", count(*) FILTER (type LIKE 'RA_%') AS total_ra_issues, "
    f"(SELECT round(avg({SCORE_SQL}), 1) FROM sig) AS avg_clinical_relevance_score FROM iss"))
def _(spark, sf_dir):
    return summaries.gate_summary(full_frame(spark, sf_dir, detail=False))


@query("avg_relevance", over_records(
    f"SELECT coalesce(round(avg({SCORE_SQL}), 1), 0.0) AS avg_relevance FROM sig"))
def _(spark, sf_dir):
    return gates.with_relevance(joined_frame(spark, sf_dir), "note").agg(
        F.coalesce(F.round(F.avg("relevance_score"), 1), F.lit(0.0)).alias("avg_relevance"))


# --- entities -------------------------------------------------------------------------------------

def _keyword_sql(keyword, category, kind, score, normalized):
    at = f"strpos(lower(note), {quoted(keyword.lower())})"
    return (f"CASE WHEN {at} > 0 THEN {{'text': substr(note, {at}, {len(keyword)}), "
            f"'category': '{category}', 'type': '{kind}', 'score': {score}::DOUBLE, "
            f"'begin': CAST({at} - 1 AS BIGINT), 'end': CAST({at} - 1 + {len(keyword)} AS BIGINT), "
            f"'normalized': {quoted(normalized) if normalized else NONE}}} END")


_KEYWORDS = ", ".join(
    [_keyword_sql(m, "MEDICATION", "GENERIC_NAME", fv.MEDICATION_SCORE, None)
     for m in fv.MEDICATION_KEYWORDS]
    + [_keyword_sql(k, "MEDICAL_CONDITION", "DX_NAME", fv.CONDITION_SCORE, n)
       for k, n in fv.CONDITION_KEYWORDS])
ENTITIES_SQL = f"""
SELECT record_id, note, list_filter([{_KEYWORDS}], lambda e: e IS NOT NULL) || list_transform(
  dates, lambda d, i: {{'text': d, 'category': 'PROTECTED_HEALTH_INFORMATION', 'type': 'DATE',
    'score': {fv.DATE_SCORE}::DOUBLE,
    'begin': CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g))) + 10 * (i - 1) AS BIGINT),
    'end': CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g))) + 10 * i AS BIGINT),
    'normalized': {NONE}}}) AS entities
FROM (SELECT *, regexp_extract_all(note, {quoted(fv.DATE_ENTITY_PATTERN)}) AS dates,
  regexp_split_to_array(note, {quoted(fv.DATE_ENTITY_PATTERN)}) AS gaps FROM src)
"""


@query("extract_entities", with_ctes("nts", """
SELECT record_id, CAST(id - 1 AS BIGINT) AS id, e.text AS text, e.category AS category,
  e.type AS type, e.score AS score, e.begin AS "begin", e.end AS "end", e.normalized AS normalized
FROM (SELECT record_id, unnest(entities) AS e, generate_subscripts(entities, 1) AS id FROM ent)""",
                                     src=NOTE_SRC, ent=ENTITIES_SQL))
def _(spark, sf_dir):
    return en.with_entities(noted(spark, sf_dir), "note").select(
        "record_id", unfold(F.col("entities"))).where("type is not null").drop("traits")


def _with_standard(df, note="note"):
    return (en.with_entities(df, note, "_entities")
            .withColumn("entities", en.standardize(F.col("_entities"))).drop("_entities"))


def _of(category, item):
    return (f"array_to_string(list_transform(list_filter(entities, lambda e: e.category = "
            f"'{category}'), lambda e: {item}), ',')")


@query("standardize_entities", with_ctes("nts", f"""
SELECT record_id, {_of('MEDICATION', 'e.text')} AS medications,
  {_of('MEDICAL_CONDITION', "e.text || '=' || e.normalized")} AS conditions,
  {_of('PROTECTED_HEALTH_INFORMATION', 'e.text')} AS dates, 0::BIGINT AS others,
  len(list_filter(entities, lambda e: e.type = 'DATE')) > 0 AS phi FROM ent""",
                                         src=NOTE_SRC, ent=ENTITIES_SQL))
def _(spark, sf_dir):
    e = F.col("entities")

    def joined(items, item):
        return F.array_join(F.transform(items, item), ",")

    return _with_standard(noted(spark, sf_dir)).select(
        "record_id", joined(e["medications"], lambda m: m["text"]).alias("medications"),
        joined(e["conditions"], lambda c: F.concat(c["text"], F.lit("="), c["normalized"]))
        .alias("conditions"), joined(e["dates"], lambda d: d["text"]).alias("dates"),
        (F.size(e["procedures"]) + F.size(e["anatomy"])).alias("others"),
        e["phi_detected"].alias("phi"))


@query("entity_totals", with_ctes("nts", """
SELECT count(*) AS records, CAST(sum(len(list_filter(entities, lambda e: e.type <> 'DATE')))
  AS BIGINT) AS total_entities,
  count(*) FILTER (len(list_filter(entities, lambda e: e.type = 'DATE')) > 0) AS phi_records
FROM ent""", src=NOTE_SRC, ent=ENTITIES_SQL))
def _(spark, sf_dir):
    return summaries.entity_totals(_with_standard(noted(spark, sf_dir)))


def email_extractor(texts: pd.Series) -> pd.Series:
    import re
    pattern = re.compile(fv.EMAIL_PATTERN)
    return texts.fillna("").map(lambda t: [
        {"id": i, "text": m.group(), "category": "PROTECTED_HEALTH_INFORMATION", "type": "EMAIL",
         "score": 1.0, "begin": m.start(), "end": m.end(), "traits": [], "normalized": None}
        for i, m in enumerate(pattern.finditer(t))])


@query("udf_extractor", with_ctes("nts", f"""
SELECT CASE WHEN record_id % 5 <> 0 THEN record_id + 9007199254740993 END AS key, unnest(regexp_extract_all({ASCII},
  {quoted(fv.EMAIL_PATTERN)})) AS found FROM src""", src=NOTE_SRC))
def _(spark, sf_dir):
    # Keys that a double can't hold, and null ones, pass beside the texts.
    keyed = noted(spark, sf_dir).withColumn("key", F.expr(
        "if(record_id % 5 <> 0, record_id + 9007199254740993, null)"))
    out = en.with_custom_entities(keyed, "note", email_extractor)
    plain = F.regexp_replace("text", r"[^\x00-\x7F]", "q")
    return out.select("key", unfold(F.col("entities"))).where("type is not null").select(
        "key", plain.alias("found"))


# --- prompts and payloads --------------------------------------------------------------------------

def _vital_sql():
    names = [n for n, *_ in fv.VITAL_RANGES]
    parts = ", ".join(f"'{n}: ' || CAST(vitals_at_discharge.{n} AS VARCHAR)" for n in names)
    return (f"coalesce(nullif(concat_ws(', ', {parts}), ''), '{fv.NO_VITALS}')")


_PROMPT_SQL = f"""
SELECT r.record_id, {quoted(fv.PROMPT_TITLE)} || chr(10) || 'Patient: ' ||
  coalesce(patient_name, 'Unknown') || ', Age: ' || coalesce(CAST(age AS VARCHAR), 'N/A') ||
  ', Gender: ' || coalesce(gender, 'N/A') || chr(10) || 'MRN: ' || mrn || chr(10) ||
  'Department: ' || coalesce(department, 'N/A') || chr(10) || 'Attending: ' ||
  attending_physician || chr(10) || chr(10) || 'Admission: ' || admission_date ||
  ' → Discharge: ' || coalesce(discharge_date, 'N/A') || chr(10) || 'Length of Stay: ' ||
  coalesce(CAST(length_of_stay_days AS VARCHAR), 'N/A') || ' days' || chr(10) || chr(10) ||
  'Diagnoses:' || chr(10) || coalesce(array_to_string(list_transform(diagnoses,
    lambda d: '  - ' || d.description || ' (ICD-10: ' || d.icd10 || ')'), chr(10)), '') ||
  chr(10) || chr(10) || 'Medications:' || chr(10) || coalesce(array_to_string(list_transform(
    medications, lambda m: '  - ' || m.name || ' ' || m.dose || ' ' || m.frequency), chr(10)), '')
  || chr(10) || chr(10) || 'Vitals at Discharge: ' || {_vital_sql()} || chr(10) ||
  CASE WHEN {_of('MEDICAL_CONDITION', 'e.text')} <> '' THEN chr(10) ||
    'NLP-Extracted Conditions: ' || array_to_string(list_transform(list_filter(entities,
      lambda e: e.category = 'MEDICAL_CONDITION'),
      lambda e: e.normalized || ' (confidence: 92%)'), ', ') ELSE '' END ||
  CASE WHEN {_of('MEDICATION', 'e.text')} <> '' THEN chr(10) || 'NLP-Extracted Medications: ' ||
    array_to_string(list_transform(list_filter(entities, lambda e: e.category = 'MEDICATION'),
      lambda e: e.text), ', ') ELSE '' END ||
  chr(10) || chr(10) || 'Clinical Note:' || chr(10) ||
  CASE WHEN note = '' THEN '{fv.NO_NOTE}' ELSE note END || chr(10) || chr(10) ||
  {quoted(fv.PROMPT_CLOSING)} AS prompt
FROM rec r JOIN ent USING (record_id)"""
_TYPED_SRC = """SELECT record_id, coalesce(t, '') AS note FROM rec LEFT JOIN (SELECT record_id,
  arg_max(note_text, seq) AS t FROM nts GROUP BY record_id) USING (record_id)"""


def prompted(spark, sf_dir):
    df = _with_standard(join_notes_typed(derived.records(spark, sf_dir),
                                         derived.notes(spark, sf_dir), "seq"))
    return df.withColumn("prompt", payloads.build_prompt(df))


@query("build_prompt", with_ctes("rec nts", """
SELECT record_id, md5(prompt) AS prompt, length(prompt) AS size FROM prm""",
                                 src=_TYPED_SRC, ent=ENTITIES_SQL, prm=_PROMPT_SQL))
def _(spark, sf_dir):
    return prompted(spark, sf_dir).select("record_id", F.md5("prompt").alias("prompt"),
                                          F.length("prompt").alias("size"))


@query("build_payload", with_ctes("rec nts", f"""
SELECT record_id, '{fv.MODEL_ID}' AS model, '{fv.CONTENT_TYPE}' AS accept,
  '{fv.API_VERSION}' AS version, 2048::BIGINT AS max_tokens, 0.1::DOUBLE AS temperature,
  0.9::DOUBLE AS top_p, 'user' AS role, md5(prompt) AS content, md5({quoted(fv.SYSTEM_PROMPT)})
  AS system FROM prm""", src=_TYPED_SRC, ent=ENTITIES_SQL, prm=_PROMPT_SQL))
def _(spark, sf_dir):
    out = prompted(spark, sf_dir).select(
        "record_id", payloads.record_payload(F.col("prompt")).alias("p"))
    out = out.withColumn("b", payloads.body_fields(F.col("p.body")))
    message = F.col("b.messages")[0]
    return out.select(
        "record_id", F.col("p.modelId").alias("model"), F.col("p.accept").alias("accept"),
        F.col("b.anthropic_version").alias("version"), "b.max_tokens", "b.temperature", "b.top_p",
        message["role"].alias("role"), F.md5(message["content"]).alias("content"),
        F.md5("b.system").alias("system"))


@query("chat_payload", """
SELECT conv_id, count(*) AS messages, string_agg(role, ',' ORDER BY turn, role, text) AS roles,
  md5(string_agg(text, '|' ORDER BY turn, role, text)) AS texts, 0.7::DOUBLE AS temperature
FROM conversations GROUP BY conv_id""")
def _(spark, sf_dir):
    out = payloads.chat_payload(table(spark, sf_dir, "conversations"))
    out = out.withColumn("b", payloads.body_fields(F.col("payload.body")))
    return out.select(
        "conv_id", "messages",
        F.array_join(F.transform("b.messages", lambda m: m["role"]), ",").alias("roles"),
        F.md5(F.array_join(F.transform("b.messages", lambda m: m["content"]), "|"))
        .alias("texts"), "b.temperature")
