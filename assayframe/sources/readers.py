"""Readers for CSV, JSON arrays and JSON Lines, and table registration."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import fixed_values as fv
from ..functions.sql import name, number_of
from . import splitting

#: Typed columns of the flat record table; every other column stays text.
FLAT_TYPES = {
    "age": "bigint", "record_id": "bigint", "length_of_stay_days": "bigint",
    "num_medications": "bigint", "systolic_bp": "bigint", "diastolic_bp": "bigint",
    "heart_rate": "bigint", "temperature_f": "double",
}

RECORD_SCHEMA = (
    "record_id bigint, mrn string, patient_name string, age bigint, gender string, "
    "admission_date string, discharge_date string, length_of_stay_days bigint, "
    "diagnoses array<struct<icd10:string,description:string>>, "
    "medications array<struct<name:string,dose:string,frequency:string>>, "
    "vitals_at_discharge struct<systolic_bp:bigint,diastolic_bp:bigint,heart_rate:bigint,"
    "temperature_f:double,respiratory_rate:bigint,oxygen_saturation:bigint>, "
    "attending_physician string, department string, clinical_note string")

NOTE_SCHEMA = ("record_id bigint, mrn string, note_type string, note_text string, "
               "author string, date string")


def read_csv_typed(spark: SparkSession, path: str, types: dict[str, str] = FLAT_TYPES,
                   columns: str | None = None, multi_line: bool = True) -> DataFrame:
    """CSV with a header; a blank or bad value of a typed column is null.

    Quotes are doubled inside quoted values, which may hold separators and line breaks. Large
    files are read by many tasks all the same (``splitting``), in two passes;
    ``multi_line=False`` reads files whose values hold no line break in one. ``columns`` (a DDL
    list of text columns) spares reading a header.
    """
    reader = spark.read.option("header", True).option("nullValue", "").option("escape", '"')
    if not multi_line:
        text = (reader.schema(columns) if columns else reader).csv(path)
    else:
        schema = T.StructType.fromDDL(columns) if columns else \
            reader.option("multiLine", True).csv(path).schema
        # Fields may be absent: a short record leaves the last ones null.
        held = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
        text = splitting.csv_records(spark, path).where("NOT first").select(
            F.from_csv("record", held.toDDL(), {"nullValue": "", "escape": '"'}).alias("row")) \
            .select("row.*")

    def typed(c: str) -> Column:
        if c not in types:
            return F.coalesce(F.col(name(c)), F.lit("")).alias(c)
        if types[c] in ("bigint", "int", "double", "float"):
            whole = types[c] in ("bigint", "int")
            return F.expr(number_of(name(c), whole)).try_cast(types[c]).alias(c)
        return F.col(name(c)).try_cast(types[c]).alias(c)

    return text.select(*[typed(c) for c in text.columns])


def read_json_array(spark: SparkSession, path: str, schema: str = RECORD_SCHEMA,
                    split: bool = True) -> DataFrame:
    """Rows of files that hold a JSON array of objects each. Large files are read by many tasks
    (``splitting``), in two passes; ``split=False`` reads a file in one task and takes a file
    that holds a single object, too."""
    if not split:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    return splitting.json_records(spark, path).select(
        F.from_json("record", schema).alias("row")).select("row.*")


def read_json_lines(spark: SparkSession, path: str, schema: str = RECORD_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).json(path)


def _variant_items(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    read = spark.read.option("singleVariantColumn", "v").option("multiLine", multi_line).json(path)
    is_array = F.schema_of_variant("v").startswith("ARRAY")
    items = F.when(is_array, F.col("v").try_cast("array<variant>")).otherwise(F.array("v"))
    return read.select(F.explode(items).alias("v"))


def _kind(field: Column) -> Column:
    return F.schema_of_variant(field)


def read_json_strict(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Nested records with what a typed reader hides kept visible.

    ``age`` is null when it is not a number, and ``age_raw`` then holds it as text;
    ``gender_is_null`` is true for an explicit null and false for an absent field;
    vital signs are text, so that bad ones can be reported. A length of stay that is not a
    number is null, and ``length_of_stay_days_raw`` holds it as text.
    """
    def at(path):
        return F.try_variant_get("v", f"$.{path}", "variant")

    age = at("age")
    numeric = _kind(age).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL|BOOLEAN)")
    text_age = F.try_variant_get("v", "$.age", "string")
    given = age.isNotNull() & ~F.is_variant_null(age)
    stay = at("length_of_stay_days")
    counted = _kind(stay).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL|BOOLEAN)")
    stated = stay.isNotNull() & ~F.is_variant_null(stay)
    vitals = F.struct(*[F.try_variant_get("v", f"$.vitals_at_discharge.{name}", "string")
                        .alias(name) for name, *_ in fv.VITAL_RANGES])
    typed = {f.name: f.dataType.simpleString()
             for f in T.StructType.fromDDL(RECORD_SCHEMA).fields}
    special = {"age", "vitals_at_discharge", "length_of_stay_days"}
    plain = [F.try_variant_get("v", f"$.{n}", t).alias(n) for n, t in typed.items()
             if n not in special]
    return _variant_items(spark, path, multi_line).select(
        *plain,
        F.when(given & numeric, F.try_variant_get("v", "$.age", "double")).alias("age"),
        F.when(given & ~numeric, F.coalesce(text_age, F.to_json(age))).alias("age_raw"),
        F.when(stated & counted, F.try_variant_get("v", "$.length_of_stay_days", "bigint"))
        .alias("length_of_stay_days"),
        F.when(stated & ~counted, F.coalesce(
            F.try_variant_get("v", "$.length_of_stay_days", "string"), F.to_json(stay)))
        .alias("length_of_stay_days_raw"),
        F.coalesce(F.is_variant_null(at("gender")), F.lit(False)).alias("gender_is_null"),
        vitals.alias("vitals_at_discharge"))


def table_name_of(file_name: str) -> str:
    """``patient_records.csv`` -> ``patient_records_csv``."""
    return re.sub(r"[^0-9a-z]+", "_", file_name.lower()).strip("_")


#: The file or folder right below a prefix that ends with a given name.
_ENTRY = "/{}/([^/]+)"


def register_tables(spark: SparkSession, prefix: str, sampling: float = 1.0) -> DataFrame:
    """Registers every CSV, JSON, Parquet and ORC file or folder under a prefix as a view
    with an inferred schema; returns (table_name, column, type). Schemas, names and the
    first line of JSON files reach the driver, not data. Types of CSV and JSON are inferred
    from the share ``sampling`` of the rows. A JSON file that begins with a bracket is read
    as an array."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(prefix)
              .select(F.regexp_extract("path", _ENTRY.format(re.escape(
                  prefix.rstrip("/").rsplit("/", 1)[-1])), 1).alias("entry"))
              .where("entry != ''").distinct())
    found = []
    for file in sorted(r[0] for r in listed.collect()):
        path, kind = f"{prefix.rstrip('/')}/{file}", file.rsplit(".", 1)[-1].lower()
        if kind == "csv":
            df = spark.read.csv(path, header=True, inferSchema=True, samplingRatio=sampling,
                                escape='"', multiLine=True)
        elif kind in ("json", "jsonl"):
            first = spark.read.text(path).where("trim(value) != ''").take(1)
            array = bool(first) and first[0][0].lstrip().startswith("[")
            df = spark.read.json(path, multiLine=array, samplingRatio=sampling)
        elif kind in ("parquet", "orc"):
            df = spark.read.format(kind).load(path)
        else:
            continue
        table = table_name_of(file)
        df.createOrReplaceTempView(table)
        found += [(table, f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return spark.createDataFrame(found, "table_name string, column string, type string")


def list_tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())
