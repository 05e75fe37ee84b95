"""Text gates, score, redaction, entities and payloads against Python's own ``re``."""

import json
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from assayframe.functions import fixed_values as fv
from assayframe.functions.patterns import by_first_letter
from assayframe.operators import entities as en, gates, payloads
from assayframe.operators.ranking import number_rows

PIECES = ["Assessment: stable.", "damn", "idiot!", "stupid  patient", "a b c", "12", "###", "...",
          "SSN 123-45-6789", "١٢٣-٤٥-٦٧٨٩", "x@y.z", "a@b.c+d@e.f", "555-123-4567", "(555) 1234567",
          "12 Main Street", "8 weeks with Dr", "poor\nhistorian", "Frequent flyer", "Plan—x",
          "diagnosis", "Diagnosis", "MG", "follow-up", "é", "éidiot", "naïve", "word " * 20, "😀",
          "2024-01-02", "20240-01-023", "METFORMIN", "Chest Pain", "Heart failure", "copd",
          "x" * 300, "male hysteria", "unreliable reporter", "History ", "a. b. c.", "\x1c", "K9"]


def notes():
    rnd = random.Random(7)
    fixed = [None, "", "   ", "\n\t", "one two", "w " * 19, "w " * 20, "w " * 39, "w " * 40,
             "a b c.", "no end here", "?!.", *PIECES]
    return fixed + [rnd.choice(["", " ", "\n"]).join(rnd.choices(PIECES, k=rnd.randint(1, 12)))
                    for _ in range(300)]


def python_gates(note):
    """(type, value) in order, from a plain statement of the gates."""
    note = note or ""
    if not note.strip():
        return [("RA_EMPTY_NOTE", None)]
    out, words = [], note.split()
    bad = re.findall(fv.PROFANITY_PATTERN, note, re.I)
    if bad:
        out.append(("RA_PROFANITY", ", ".join(bad[:3])))
    phi = [n for n, p, f in [("SSN", fv.SSN_PATTERN, 0), ("email", fv.EMAIL_PATTERN, 0),
                             ("phone_number", fv.PHONE_PATTERN, 0),
                             ("street_address", fv.ADDRESS_PATTERN, re.I)] if re.search(p, note, f)]
    if phi:
        out.append(("RA_PHI_EXPOSURE", ", ".join(phi)))
    if len(words) < 20:
        out.append(("RA_LOW_RELEVANCE", str(len(words))))
    if not re.findall(fv.TERM_PATTERN, note, re.I):
        out.append(("RA_LOW_RELEVANCE", None))
    if sum(c.isalpha() or c.isspace() for c in note) / len(note) < 0.60:
        out.append(("RA_GARBLED_TEXT", "?"))
    bias = re.findall(fv.BIAS_PATTERN, note, re.I)
    if bias:
        out.append(("RA_BIAS_INDICATOR", ", ".join(bias[:3])))
    if not any(len(s.split()) >= 3 for s in re.split(r"[.!?]+", note.strip())):
        out.append(("RA_LOW_COHERENCE", None))
    if not re.search(fv.SECTION_PATTERN, note, re.I) and len(words) >= 40:
        out.append(("RA_UNSTRUCTURED_NOTE", None))
    return out


def python_score(note):
    if not note or not note.strip():
        return 0.0
    words = len(note.split())
    parts = re.split(r"[.!?]+", note.strip())
    full = sum(len(s.split()) >= 3 for s in parts)
    return (min(words / 50, 1) * 30
            + min(len(set(re.findall(fv.TERM_PATTERN, note, re.I))) / words * 10, 1) * 30
            + min(len(re.findall(fv.SECTION_PATTERN, note, re.I)) / 3, 1) * 20
            + full / len(parts) * 20)


@pytest.fixture(scope="module")
def gated(spark):
    rows = list(enumerate(notes()))
    df = spark.createDataFrame(rows, "record_id int, note string").repartition(4)
    return dict(rows), {r["record_id"]: r for r in gates.with_gates(
        df, "note", "record_id").collect()}


def test_gates_equal_python(gated):
    texts, got = gated
    for i, note in texts.items():
        mine = [(x["type"], "?" if x["type"] == "RA_GARBLED_TEXT" else x["value"])
                for x in got[i]["gate_issues"]]
        assert mine == python_gates(note), repr(note)


def test_score_equals_python(gated):
    texts, got = gated
    for i, note in texts.items():
        assert abs(got[i]["relevance_score"] - python_score(note)) <= 0.0501, repr(note)


def test_bias_message_lists_matches(spark):
    df = spark.createDataFrame([(1, "a poor historian and a frequent\nflyer")], "k int, note string")
    message = gates.with_gates(df, "note", "k").select(F.expr(
        "filter(gate_issues, i -> i.type = 'RA_BIAS_INDICATOR')[0].message")).first()[0]
    assert "record 1: ['poor historian', 'frequent\\nflyer']. This" in message


@pytest.mark.parametrize("pattern", [fv.PROFANITY_PATTERN, fv.TERM_PATTERN, fv.BIAS_PATTERN,
                                     fv.SECTION_PATTERN])
def test_grouped_patterns_find_the_same(pattern):
    for note in notes():
        if note:
            assert re.findall(pattern, note, re.I) == re.findall(by_first_letter(pattern), note,
                                                                 re.I)


def test_redaction_and_route(spark):
    df = spark.createDataFrame([("SSN 123-45-6789, a.b@c.de or 555-123-4567 at 12 Main Street on "
                                 "2024-01-02",), ("clean",), (None,)], "note string")
    got = [r[0] for r in df.select(gates.redact_phi(F.col("note"))).collect()]
    assert got == ["SSN [SSN], [EMAIL] or [PHONE_NUMBER] at [STREET_ADDRESS] on [DATE]", "clean",
                   None]


def test_redaction_equals_python(spark):
    texts = [t for t in notes() if t] + ["x@y.z+a@b.c+d@e.f", "a@b", "..@-.-@a.b", "@a.b", "é@é.é",
                                         "a@b.c@d.e f@g@h.i"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, note string")
    for row in df.select("k", gates.redact_phi(F.col("note")).alias("r")).collect():
        want = texts[row["k"]]
        for name, pattern, flags in [
                ("SSN", fv.SSN_PATTERN, 0), ("EMAIL", fv.EMAIL_PATTERN, 0),
                ("PHONE_NUMBER", fv.PHONE_PATTERN, 0), ("STREET_ADDRESS", fv.ADDRESS_PATTERN, re.I),
                ("DATE", fv.DATE_ENTITY_PATTERN, 0)]:
            want = re.sub(pattern, f"[{name}]", want, flags=flags)
        assert row["r"] == want, repr(texts[row["k"]])


def test_long_texts_stay_linear(spark):
    blob = "aB3+" * 100_000
    rows = [(1, blob + " a@b.cd " + blob), (2, "2024-01-02 " * 20_000), (3, blob)]
    df = spark.createDataFrame(rows, "k int, note string")
    out = {r["k"]: r for r in en.with_entities(gates.with_gates(df, "note", "k"), "note").select(
        "k", F.size("entities").alias("n"), F.try_element_at("entities", F.lit(-1))["end"].alias("end"),
        F.length(gates.redact_phi(F.col("note"))).alias("redacted")).collect()}
    assert out[1]["redacted"] == 2 * len(blob) + 2 + len("[EMAIL]")
    assert (out[2]["n"], out[2]["end"]) == (20_000, 20_000 * 11 - 1)
    assert out[3]["n"] == 0


def python_entities(text):
    out, low = [], (text or "").lower()
    for k in [*fv.MEDICATION_KEYWORDS, *(k for k, _ in fv.CONDITION_KEYWORDS)]:
        at = low.find(k.lower())
        if at >= 0:
            out.append((text[at:at + len(k)], at, at + len(k)))
    out += [(m.group(), m.start(), m.end())
            for m in re.finditer(fv.DATE_ENTITY_PATTERN, text or "")]
    return [(i, *e) for i, e in enumerate(out)]


def test_entities_equal_python(spark):
    texts = notes()
    df = spark.createDataFrame(list(enumerate(texts)), "k int, note string")
    for row in en.with_entities(df, "note").collect():
        mine = [(e["id"], e["text"], e["begin"], e["end"]) for e in row["entities"]]
        assert mine == python_entities(texts[row["k"]]), repr(texts[row["k"]])


def test_standard_form_and_custom_extractor(spark):
    df = spark.createDataFrame([("diabetes, Aspirin",), ("",)], "note string")
    out = en.with_entities(df, "note", "e").select(en.standardize(F.col("e")).alias("s")).collect()
    first = out[0]["s"]
    assert first["medications"][0]["text"] == "Aspirin" and not first["phi_detected"]
    assert first["conditions"][0]["normalized"] == "Type 2 diabetes mellitus"

    def sizes(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"id": 0, "text": t, "category": "X", "type": "Y", "score": 1.0,
                                     "begin": 0, "end": len(t), "traits": [], "normalized": None}])

    assert {r["entities"][0]["end"] for r in en.with_custom_entities(
        df, "note", sizes).collect()} == {17, 0}


def test_prompt_and_payload(spark):
    df = spark.createDataFrame([(1, None, None, None, [("I10", "High")], None, None, "")],
                               "record_id int, patient_name string, age int, gender string, "
                               "diagnoses array<struct<icd10:string,description:string>>, "
                               "medications array<struct<name:string,dose:string,"
                               "frequency:string>>, vitals_at_discharge struct<systolic_bp:int>, "
                               "note string")
    df = en.with_entities(df, "note", "e").withColumn("entities", en.standardize(F.col("e")))
    row = df.select(payloads.build_prompt(df).alias("p")).select(
        "p", payloads.record_payload(F.col("p")).alias("r")).first()
    assert "Patient: Unknown, Age: N/A, Gender: N/A" in row["p"]
    assert "  - High (ICD-10: I10)" in row["p"] and "Vitals at Discharge: Not recorded" in row["p"]
    assert fv.NO_NOTE in row["p"]
    body = json.loads(row["r"]["body"])
    assert body["messages"] == [{"role": "user", "content": row["p"]}]
    assert (body["temperature"], body["max_tokens"], body["system"]) == (0.1, 2048,
                                                                         fv.SYSTEM_PROMPT)
    plain = spark.range(1).select(payloads.build_payload(F.array(F.struct(
        F.lit("user").alias("role"), F.lit("é").alias("content")))).alias("r")).first()["r"]
    assert "system" not in json.loads(plain["body"])


def test_long_conversations_go_on_in_parts(spark):
    rows = [(1, t, "user", f"m{t}") for t in range(95)] + [(2, 0, "user", "x")] * 3 + \
           [(3, t, "assistant", f"n{t}") for t in range(10)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    out = payloads.chat_payload(df.repartition(6), max_messages=10).withColumn(
        "b", payloads.body_fields(F.col("payload.body"))).orderBy("conv_id", "part").collect()
    assert [r["messages"] for r in out if r["conv_id"] == 1] == [10] * 9 + [5]
    said = [m["content"] for r in out if r["conv_id"] == 1 for m in r["b"]["messages"]]
    assert said == [f"m{t}" for t in range(95)]
    assert [r["messages"] for r in out if r["conv_id"] > 1] == [3, 10]


def test_rows_of_a_hot_group_are_numbered(spark):
    rows = [(None if i % 3 == 0 else i % 2, i % 50) for i in range(600)]
    df = spark.createDataFrame(rows, "g int, x int").repartition(5)
    got = number_rows(df, ["g"], ["x"]).collect()
    for g in (None, 0, 1):
        mine = sorted((r["position"], r["x"]) for r in got if r["g"] == g)
        assert [p for p, _ in mine] == list(range(1, len(mine) + 1))
        assert [x for _, x in mine] == sorted(x for h, x in rows if h == g)
    assert sorted(r["position"] for r in number_rows(df, [], ["x"]).collect()) == \
        list(range(1, 601))


def test_route_and_types_alone_equal_full_checks(spark):
    from assayframe.operators import validation as v
    from assayframe.plans import derived, text_queries

    sf_dir = "/root/testdata/sf0.001"
    noted = text_queries.noted(spark, sf_dir)
    full = gates.with_gates(noted, "note", "record_id").select(
        "record_id", gates.gate_route(F.col("gate_issues")).alias("route"))
    assert sorted(full.collect()) == sorted(
        gates.with_route(noted, "note").select("record_id", "route").collect())
    joined = text_queries.joined_frame(spark, sf_dir)

    def told(detail):
        out = v.validate(joined, "strict", derived.AS_OF, "note", detail=detail)
        return sorted(map(str, out.select(
            "record_id", "_validation.status", "_validation.error_count",
            "_validation.warning_count", "_validation.relevance_score", F.transform(
                "_validation.issues", lambda i: F.concat(i["type"], i["severity"]))).collect()))

    assert told(True) == told(False)
    assert v.validate(joined, "full", derived.AS_OF, "note").schema == \
        v.validate(joined, "full", derived.AS_OF, "note", detail=False).schema


def test_counts_keep_no_matches(spark):
    """Words, letters and sentences are counted without an array of matches, and alike."""
    signals = gates.text_signals(F.col("note"))
    for name in ("words", "letters", "sentences"):
        plan = spark.createDataFrame([("a",)], "note string").select(
            signals[name])._jdf.queryExecution().optimizedPlan().toString()
        assert "regexp_extract_all" not in plan and "regexp_replace" not in plan
    texts = [None, "", " ", " \n\x1c ", "a", " a ", "a b c\x1fd", "...", "a. b!? c", "😀 é1-2 ß",
             "١٢ x", "́a"]
    got = spark.createDataFrame([(t,) for t in texts], "note string").select(
        "note", signals["words"], signals["letters"], signals["sentences"]).collect()
    for note, words, letters, sentences in got:
        note = note or ""
        assert words == len(note.split()), repr(note)
        assert letters == sum(c.isalpha() or c.isspace() for c in note), repr(note)
        assert sentences == len(re.findall("[.!?]+", note)) + 1, repr(note)


def test_words_after_optional_parts_are_told_early(spark):
    pattern = by_first_letter(fv.BIAS_PATTERN)
    assert pattern.startswith("(?=(?-i:[") and pattern.endswith(fv.BIAS_PATTERN)
    notes_ = ["an unreliable historian", "Reliable reporter", "ſhe claims pain", "éhe claims pain",
              "x_he alleges pain", "-HE alleges symptoms", "oKay obese lazy"]
    got = spark.createDataFrame([(n,) for n in notes_], "note string").select(
        F.size(gates.find_words(F.col("note"), fv.BIAS_PATTERN))).collect()
    assert [r[0] for r in got] == [1, 1, 1, 0, 0, 1, 1]
