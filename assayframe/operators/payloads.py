"""Prompts and request payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as fv
from .ranking import number_rows


def _shown(df: DataFrame, name: str, default: str = "N/A") -> Column:
    if name not in df.columns:
        return F.lit(default)
    return F.coalesce(F.col(name).cast("string"), F.lit(default))


def _lines(df: DataFrame, column: str, line) -> Column:
    if column not in df.columns:
        return F.lit("")
    return F.coalesce(F.array_join(F.transform(F.col(column), line), "\n"), F.lit(""))


def _plain(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("None"))


def build_prompt(df: DataFrame, entities: str = "entities", note: str = "note") -> Column:
    """The user message for a record, its standardized entities and its note."""
    vitals = F.lit(fv.NO_VITALS)
    if "vitals_at_discharge" in df.columns:
        names = df.schema["vitals_at_discharge"].dataType.names
        present = F.array_compact(F.array(*[
            F.concat(F.lit(f"{n}: "), F.col(f"vitals_at_discharge.{n}").cast("string"))
            for n in names]))
        vitals = F.when(F.size(present) > 0, F.array_join(present, ", ")).otherwise(vitals)
    diagnoses = _lines(df, "diagnoses", lambda d: F.concat(
        F.lit("  - "), _plain(d["description"]), F.lit(" (ICD-10: "), _plain(d["icd10"]),
        F.lit(")")))
    medications = _lines(df, "medications", lambda m: F.concat(
        F.lit("  - "), _plain(m["name"]), F.lit(" "), _plain(m["dose"]), F.lit(" "),
        _plain(m["frequency"])))
    e = F.col(entities)

    def found(items, label, line):
        return F.when(F.size(items) > 0, F.concat(
            F.lit(f"\n{label}: "), F.array_join(F.transform(items, line), ", "))
        ).otherwise("")

    context = F.concat(
        found(e["conditions"], "NLP-Extracted Conditions", lambda c: F.concat(
            c["normalized"], F.format_string(" (confidence: %.0f%%)", c["confidence"] * 100))),
        found(e["medications"], "NLP-Extracted Medications", lambda m: m["text"]))
    text = F.coalesce(F.nullif(F.col(note), F.lit("")), F.lit(fv.NO_NOTE))
    parts = [
        f"{fv.PROMPT_TITLE}\nPatient: ", _shown(df, "patient_name", "Unknown"),
        ", Age: ", _shown(df, "age"), ", Gender: ", _shown(df, "gender"),
        "\nMRN: ", _shown(df, "mrn"), "\nDepartment: ", _shown(df, "department"),
        "\nAttending: ", _shown(df, "attending_physician"),
        "\n\nAdmission: ", _shown(df, "admission_date"),
        " → Discharge: ", _shown(df, "discharge_date"),
        "\nLength of Stay: ", _shown(df, "length_of_stay_days"), " days",
        "\n\nDiagnoses:\n", diagnoses, "\n\nMedications:\n", medications,
        "\n\nVitals at Discharge: ", vitals, "\n", context,
        "\n\nClinical Note:\n", text, f"\n\n{fv.PROMPT_CLOSING}",
    ]
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def build_payload(messages: Column, system: str = "", model_id: str = fv.MODEL_ID,
                  max_tokens: int = 2048, temperature: float = 0.7, top_p: float = 0.9,
                  version: str = fv.API_VERSION) -> Column:
    """Request struct whose body is JSON text; ``messages`` is an array of (role, content)."""
    body = [F.lit(version).alias("anthropic_version"), F.lit(max_tokens).alias("max_tokens"),
            F.lit(temperature).alias("temperature"), F.lit(top_p).alias("top_p"),
            messages.alias("messages")]
    if system:
        body.append(F.lit(system).alias("system"))
    return F.struct(
        F.lit(model_id).alias("modelId"), F.lit(fv.CONTENT_TYPE).alias("contentType"),
        F.lit(fv.CONTENT_TYPE).alias("accept"),
        F.to_json(F.struct(*body), {"ignoreNullFields": "false"}).alias("body"))


def record_payload(prompt: Column, system: str = fv.SYSTEM_PROMPT) -> Column:
    """The payload of one record, with the settings for factual output."""
    message = F.struct(F.lit("user").alias("role"), prompt.alias("content"))
    return build_payload(F.array(message), system, temperature=0.1, top_p=0.9, max_tokens=2048)


def body_fields(body: Column) -> Column:
    """A payload body parsed back."""
    return F.from_json(
        body, "anthropic_version string, max_tokens int, temperature double, top_p double, "
              "messages array<struct<role:string,content:string>>, system string")


def chat_payload(df: DataFrame, conversation: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text", max_messages: int | None = None,
                 **settings) -> DataFrame:
    """One payload per conversation, with its turns in order; a payload is one value, so a
    task holds the conversation it is made of.

    With ``max_messages`` a payload holds that many turns at most: conversations are numbered
    across tasks, none is gathered whole, and a longer one goes on in the next ``part``.
    """
    order = [turn, role, text]
    if max_messages is None:
        df = df.withColumn("part", F.lit(0))
    else:
        df = number_rows(df, [conversation], order).withColumn(
            "part", F.floor((F.col("position") - 1) / max_messages)).drop("position")
    turns = F.array_sort(F.collect_list(F.struct(*order)))
    return (df.groupBy(conversation, F.col("part").cast("long").alias("part"))
            .agg(turns.alias("_turns"))
            .withColumn("_messages", F.transform("_turns", lambda t: F.struct(
                t[role].alias("role"), t[text].alias("content"))))
            .select(conversation, "part", F.size("_messages").alias("messages"),
                    build_payload(F.col("_messages"), **settings).alias("payload")))
