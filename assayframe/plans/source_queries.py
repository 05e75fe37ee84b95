"""Queries: sources, sinks and fault injection, written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rules as r
from ..session import fresh_path
from ..sources import faults, metric_sink, readers, writers
from . import derived
from .derived import with_ctes
from .metric_queries import EVENT_METRICS, event_metrics
from .registry import query, table
from .rule_queries import _results, over_results
from .text_queries import full_frame, full_sql


@query("src_csv_typed", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN NULL ELSE o_custkey
  END AS age, CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice END
  AS temperature_f, CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 3 = 0 THEN
  'Ann "Bee", ' || chr(10) || o_orderpriority ELSE o_orderpriority END AS department
FROM orders""")
def _(spark, sf_dir):
    k = F.col("o_orderkey")
    path = fresh_path(spark, "csv")
    table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(k % 7 == 0, "").when(k % 11 == 0, "3.0x").otherwise(
            F.col("o_custkey").cast("string")).alias("age"),
        F.when(k % 13 == 0, "").when(k % 17 == 0, "98.6F").otherwise(
            F.col("o_totalprice").cast("string")).alias("temperature_f"),
        F.when(k % 5 == 0, "").when(k % 3 == 0, F.concat(
            F.lit('Ann "Bee", \n'), "o_orderpriority")).otherwise(F.col("o_orderpriority"))
        .alias("department"),
    ).write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    return readers.read_csv_typed(spark, path, {**readers.FLAT_TYPES, "o_orderkey": "bigint"})


_CUSTOMERS = "SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, " \
             "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_mktsegment || ' é' END AS c_mktsegment " \
             "FROM customer"
_CUSTOMER_SCHEMA = ("c_custkey bigint, c_name string, c_nationkey bigint, c_acctbal double, "
                    "c_mktsegment string")


def _customer_arrays(spark, sf_dir):
    """Files with a JSON array each, one per task."""
    path = fresh_path(spark, "arrays")
    segment = F.when(F.col("c_custkey") % 9 != 0, F.concat("c_mktsegment", F.lit(" é")))
    rows = table(spark, sf_dir, "customer").withColumn("c_mktsegment", segment)
    writers.write_json_arrays(rows, path)
    return path


@query("src_json_array", _CUSTOMERS)
def _(spark, sf_dir):
    return readers.read_json_array(spark, _customer_arrays(spark, sf_dir),
                                   _CUSTOMER_SCHEMA)


@query("json_array_to_lines", _CUSTOMERS)
def _(spark, sf_dir):
    path = fresh_path(spark, "lines")
    writers.array_to_lines(spark, _customer_arrays(spark, sf_dir), path, _CUSTOMER_SCHEMA)
    return readers.read_json_lines(spark, path, _CUSTOMER_SCHEMA)


@query("src_json_strict", with_ctes("rec", """
SELECT record_id, CASE WHEN record_id % 7 <> 0 THEN CAST(age AS DOUBLE) END AS age,
  CASE WHEN record_id % 7 = 0 AND age IS NOT NULL THEN 'age ' || age END AS age_raw,
  gender, gender IS NULL AND record_id % 2 = 0 AS gender_is_null,
  CASE WHEN record_id % 10 > 1 THEN length_of_stay_days END AS length_of_stay_days,
  CASE record_id % 10 WHEN 0 THEN 'two' WHEN 1 THEN '2' END AS stay_raw,
  CAST(vitals_at_discharge.heart_rate AS VARCHAR) AS heart_rate FROM rec"""))
def _(spark, sf_dir):
    path = fresh_path(spark, "strict")
    rec = derived.records(spark, sf_dir)
    # Text ages where the key divides by 7; an explicit null gender on even keys only.
    age = F.when((F.col("record_id") % 7 == 0) & F.col("age").isNotNull(), F.concat(
        F.lit('"age ', ), F.col("age").cast("string"), F.lit('"'))).otherwise(
        F.coalesce(F.col("age").cast("string"), F.lit("null")))
    rest = F.to_json(F.struct("record_id", "gender", "vitals_at_discharge"))
    gender = F.when(F.col("gender").isNull() & (F.col("record_id") % 2 == 0),
                    ',"gender":null').otherwise("")
    stay = F.when(F.col("record_id") % 10 == 0, '"two"').when(
        F.col("record_id") % 10 == 1, '"2"').otherwise(
        F.coalesce(F.col("length_of_stay_days").cast("string"), F.lit("null")))
    rec.select(F.concat(F.lit('{"length_of_stay_days":'), stay, F.lit(',"age":'), age, gender,
                        F.lit(","),
                        F.substring(rest, 2, 1 << 30)).alias("value")).write.text(path)
    return readers.read_json_strict(spark, path, multi_line=False).select(
        "record_id", "age", "age_raw", "gender", "gender_is_null", "length_of_stay_days",
        F.col("length_of_stay_days_raw").alias("stay_raw"),
        F.col("vitals_at_discharge.heart_rate").alias("heart_rate"))


@query("register_tables", """
SELECT 'customers_csv' AS table_name, count(*) AS rows, 'c_acctbal:double' AS sample FROM customer
UNION ALL SELECT 'orders_json', count(*), 'o_totalprice:double' FROM orders
UNION ALL SELECT 'parts_parquet', count(*), 'p_retailprice:double' FROM part""")
def _(spark, sf_dir):
    path = fresh_path(spark, "lake")
    table(spark, sf_dir, "customer").write.option("header", True).csv(f"{path}/customers.csv")
    table(spark, sf_dir, "orders").write.json(f"{path}/orders.json")
    table(spark, sf_dir, "part").write.parquet(f"{path}/parts.parquet")
    columns = readers.register_tables(spark, path)
    rows = None
    for name in ("customers_csv", "orders_json", "parts_parquet"):
        one = spark.table(name).agg(F.count("*").alias("rows")).withColumn("name", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    sample = columns.where(F.col("column").isin("c_acctbal", "o_totalprice", "p_retailprice"))
    return sample.join(rows, F.col("table_name") == F.col("name")).select(
        "table_name", "rows", F.concat("column", F.lit(":"), "type").alias("sample"))


@query("sink_report", over_results("""
SELECT table_name, outcome, count(*) AS rules FROM res GROUP BY ALL
UNION ALL SELECT NULL, 'total', count(*) FROM res"""))
def _(spark, sf_dir):
    path = fresh_path(spark, "report")
    results = _results(spark, sf_dir)
    writers.write_report(results, path)
    rows = spark.read.schema(results.schema).parquet(f"{path}/rule_results")
    total = spark.read.json(f"{path}/summary").where(F.col("table_name").isNull()).select(
        F.lit(None).cast("string").alias("table_name"), F.lit("total").alias("outcome"),
        F.col("total_rules").alias("rules"))
    return rows.groupBy("table_name", "outcome").agg(F.count("*").alias("rules")).unionByName(total)


def _told(key):
    return key.endswith(".RowCount") | key.endswith(".Completeness")


@query("sink_results_partitioned", over_results("""
SELECT table_name, '2024' AS year, '03' AS month, '14' AS day, rule, outcome,
  outcome = 'PASS' AS explained, CASE WHEN type = 'RowCount' THEN 'Dataset.*.RowCount'
    WHEN type = 'Completeness' THEN 'Column.' || regexp_extract(rule, '"([^"]+)"', 1)
      || '.Completeness' END AS named,
  CASE WHEN type IN ('RowCount', 'Completeness') THEN round(metric, 4) END AS measured,
  checked::DOUBLE AS checked FROM res"""))
def _(spark, sf_dir):
    path = fresh_path(spark, "results")
    writers.write_results(_results(spark, sf_dir), path, "2024-03-14 10:00:00")
    back = writers.read_results(spark, path)
    names = F.map_keys("evaluated_metrics")

    def value(test):
        return F.element_at("evaluated_metrics", F.get(F.filter(names, test), 0))

    return back.select("table_name", "year", "month", "day", "rule", "outcome",
                       F.col("failure_reason").isNull().alias("explained"),
                       F.get(F.filter(names, _told), 0).alias("named"),
                       F.round(value(lambda k: _told(k)), 4).alias("measured"),
                       value(lambda k: k.endswith(".Checked")).alias("checked"))


@query("sink_validation", full_sql("""
SELECT 'summary' AS output, count(*) AS records FROM st
UNION ALL SELECT 'flagged', count(*) FILTER (status <> 'PASS') FROM st
UNION ALL SELECT 'clean', count(*) FILTER (status <> 'FAIL') FROM st
UNION ALL SELECT 'gates', (SELECT count(*) FROM iss WHERE type LIKE 'RA_%')
UNION ALL SELECT type, count(*) FROM iss GROUP BY type"""))
def _(spark, sf_dir):
    path = fresh_path(spark, "validation")
    writers.write_validation(full_frame(spark, sf_dir), path)

    def output(name, df):
        return df.select(F.lit(name).alias("output"), F.col("records"))

    def counted(name):
        return spark.read.parquet(f"{path}/{name}").agg(F.count("*").alias("records"))

    summary = spark.read.json(f"{path}/validation_summary").withColumnRenamed("total", "records")
    gates = spark.read.json(f"{path}/gate_summary").withColumnRenamed("total_ra_issues", "records")
    by_type = spark.read.json(f"{path}/errors_by_type").select(
        F.col("type").alias("output"), F.col("issues").alias("records"))
    return (output("summary", summary).unionByName(by_type).unionByName(output("flagged", counted("flagged")))
            .unionByName(output("clean", counted("clean"))).unionByName(output("gates", gates)))


@query("sink_metrics_batched", f"""
WITH {EVENT_METRICS}, n AS (SELECT *, row_number() OVER (ORDER BY ts, name) AS i FROM em)
SELECT (i - 1) // 20 AS batch_id, count(*) AS metric_count, round(sum(value), 4) AS total
FROM n GROUP BY ALL""")
def _(spark, sf_dir):
    path = fresh_path(spark, "metrics")
    writers.write_metrics(event_metrics(spark, sf_dir), path)
    back = spark.read.schema("namespace string, batch_id bigint, metric_count bigint, "
                             "metrics array<struct<name:string,value:double>>").json(path)
    total = F.aggregate("metrics", F.lit(0.0), lambda a, x: a + x["value"])
    return back.select("batch_id", "metric_count", F.round(total, 4).alias("total"))


@query("sink_metric_groups", f"""
WITH {EVENT_METRICS} SELECT name, count(*) AS n, round(sum(value), 4) AS total, true AS small
FROM em GROUP BY name""")
def _(spark, sf_dir):
    """All metrics, in groups of 20 at most."""
    path = fresh_path(spark, "metric-groups")
    metrics = event_metrics(spark, sf_dir)
    metric_sink.write_metric_groups(metrics, path)
    back = metric_sink.read_metric_groups(spark, path)
    small = back.agg(F.coalesce(F.max(F.size("metrics")), F.lit(0)).alias("most"))
    total = back.select(F.inline("metrics")).groupBy("name").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return total.join(F.broadcast(small), F.lit(True)).select(
        "name", "n", "total", (F.col("most") <= 20).alias("small"))


_FAULTS = ["missing_name", "future_date", "negative_age", "empty_meds", "duplicate_mrn", "encoding",
           "impossible_bp", "extreme_temp", "negative_hr", "missing_bp", "bad_code", "blank_code"]
_V = "vitals_at_discharge"


def _hex(at):
    return f"CAST('0x' || substr(md5(record_id || '|42'), {at}, 8) AS BIGINT)"


def _vital(name, fault, value):
    return (f"CASE WHEN {_V} IS NULL THEN NULL WHEN fault = '{fault}' THEN {value} "
            f"ELSE {_V}.{name} END")


@query("inject_faults", with_ctes("rec", f"""
SELECT record_id, fault, CASE fault WHEN 'missing_name' THEN '' WHEN 'encoding'
  THEN 'Zoë Łęcka-Ørsted' ELSE patient_name END AS patient_name,
  CASE WHEN fault = 'future_date' THEN '2001-01-31' ELSE discharge_date END AS discharge_date,
  CASE WHEN fault = 'negative_age' THEN -5 ELSE age END AS age,
  CASE WHEN fault = 'empty_meds' THEN 0 ELSE len(medications) END AS meds,
  CASE WHEN fault = 'duplicate_mrn' THEN 'MRN-000001' ELSE mrn END AS mrn,
  CASE WHEN fault = 'missing_bp' THEN NULL ELSE {_vital('systolic_bp', 'impossible_bp',
    '300 + record_id % 201')} END AS systolic_bp,
  {_vital('temperature_f', 'extreme_temp', '110.0::DOUBLE + record_id % 11')} AS temperature_f,
  {_vital('heart_rate', 'negative_hr', '-1 - record_id % 50')} AS heart_rate,
  CASE WHEN diagnoses IS NULL THEN NULL ELSE len(diagnoses) +
    CASE WHEN fault IN ('bad_code', 'blank_code') THEN 1 ELSE 0 END END AS codes
FROM (SELECT *, CASE WHEN {_hex(1)} < {int(0.12 * 2 ** 32)} THEN
  list_extract({_FAULTS}, {_hex(9)} % 12 + 1) END AS fault FROM rec)"""))
def _(spark, sf_dir):
    rec = derived.records(spark, sf_dir)
    out = faults.inject_faults(rec, "record_id", faults.record_faults("2001-01-01"))
    return out.select(
        "record_id", "fault", "patient_name", "discharge_date", "age",
        F.size("medications").alias("meds"), "mrn", f"{_V}.systolic_bp", f"{_V}.temperature_f",
        f"{_V}.heart_rate", F.size("diagnoses").alias("codes"))


@query("rejected_routes", """
SELECT CASE WHEN o_totalprice < 10000 OR o_totalprice > 490000 THEN 'rejected' ELSE 'processed' END
  AS route, count(*) AS orders, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY ALL""")
def _(spark, sf_dir):
    from ..operators.routing import route_rows
    path = fresh_path(spark, "routes")
    writers.write_routes(route_rows(table(spark, sf_dir, "orders"),
                                    [r.value_range("o_totalprice", 10000, 490000)]), path)
    return spark.read.parquet(path).groupBy("route").agg(
        F.count("*").alias("orders"), F.sum("o_orderkey").alias("keys"))
