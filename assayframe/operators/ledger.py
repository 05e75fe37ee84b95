"""A ledger of quality runs: an unchanged table is not read again, a grown one only where it grew.

A run leaves, under its id in the ledger's folder, what each new file adds to each rule (counts,
and for means and deviations the moments), the distinct keys of each file for uniqueness, and
its results. The row in ``runs`` is written last: a run that ended before has left nothing that
counts. The next run compares the files there are (path, length, time) with those the ledger
knows. If all are the same, and so is the rule set, the last result is returned; else only files
that are new or changed are read, and all files' shares are merged. Files that are gone drop out.

Custom SQL rules look at the table as a whole: a changed table is read for them.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.predicates import field_type
from ..functions.sql import name
from .rules import (
    _PASSED, NO_COUNT, RESULT_COLUMNS, Measures, Rule, _analyzable, _free_sql, _result,
)

_RUN = ("table_name string, run_id string, run_ts timestamp, files string, ruleset string, "
        "schema string")
_FILE = ["file", "length", "modified"]
_MOMENT = re.compile(r"(avg|stddev_samp)\((`[^)]+`)\)")


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(file, length, modified) of the files under a path; no content is read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(
        _plain("path").alias("file"), "length", F.col("modificationTime").alias("modified"))


def _plain(column: str):
    """A file's path with one slash after its scheme, however it was written."""
    return F.regexp_replace(column, "^([a-z0-9]+):/+", "$1:/")


def fingerprint(files: DataFrame) -> str:
    """A digest of a listing that doesn't depend on its order."""
    row = files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0)),
                    F.bit_xor(F.xxhash64(*_FILE)), F.bit_xor(F.xxhash64(F.lit(1), *_FILE))).first()
    return "-".join(map(str, row))


def _measures(rule: Rule, schema: T.StructType) -> Measures | None:
    try:
        return rule.measure(schema) if rule.measure else None
    except (KeyError, TypeError, AnalysisException):
        return None


def ruleset_print(ruleset: Sequence[Rule], schema: T.StructType) -> str:
    """A digest of what the rules ask of a table of this schema."""
    asked = [(r.text, r.sql, r.accept, r.unique_key, str(_measures(r, schema))) for r in ruleset]
    return hashlib.sha256(json.dumps([asked, schema.json()], default=str).encode()).hexdigest()


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def last_run(spark: SparkSession, folder: str, table_name: str):
    """The newest whole run of a table, or None."""
    runs = _read(spark, f"{folder}/runs")
    if runs is None:
        return None
    return runs.where(F.col("table_name") == table_name) \
        .orderBy(F.desc("run_ts"), F.desc("run_id")).first()


def results_of(spark: SparkSession, folder: str, run_id: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/results/run={run_id}").select(*RESULT_COLUMNS)


def evaluate(spark: SparkSession, path: str, ruleset: Sequence[Rule], table_name: str,
             folder: str, run_id: str, run_ts=None, fmt: str = "parquet") -> DataFrame:
    """One row per rule of the table under ``path``, as ``rules.evaluate`` gives, with the
    ledger in ``folder``. ``run_id`` names a new run; if nothing has changed, the results are
    those of the last one, under its id."""
    files = listing(spark, path)
    now, last = fingerprint(files), last_run(spark, folder, table_name)
    if last is not None and last["files"] == now:
        if last["ruleset"] == ruleset_print(ruleset, T.StructType.fromJson(
                json.loads(last["schema"]))):
            return results_of(spark, folder, last["run_id"])
    try:
        schema = spark.read.format(fmt).load(path).schema
    except AnalysisException:  # read from one file, which may be an old one that is corrupt by now
        schema = spark.read.format(fmt).option("mergeSchema", True).load(path).schema
    asked = ruleset_print(ruleset, schema)
    states, keys = _known(spark, folder, table_name, asked)
    fresh = files if states is None else files.join(
        states.select(*_FILE).distinct(), _FILE, "left_anti")
    paths = [r["file"] for r in fresh.select("file").collect()]  # a row per new file
    measures = _usable(spark, schema, ruleset)
    if paths:
        new = spark.read.schema(schema).format(fmt).load(paths).withColumn(
            "_file", _plain("_metadata.file_path"))
        _write_states(new, fresh, measures, table_name, asked, f"{folder}/states/run={run_id}")
        _write_keys(new, fresh, ruleset, schema, table_name, asked, f"{folder}/keys/run={run_id}")
    _result_rows(spark, path, fmt, files, ruleset, schema, measures, table_name, run_id,
                 _parts(spark, folder, "states", run_id, states, bool(paths)),
                 _parts(spark, folder, "keys", run_id, keys, bool(paths))).write.parquet(
        f"{folder}/results/run={run_id}")
    row = spark.createDataFrame([(table_name, run_id, None, now, asked, schema.json())], _RUN)
    row.withColumn("run_ts", F.current_timestamp() if run_ts is None else F.lit(run_ts).cast(
        "timestamp")).coalesce(1).write.mode("append").parquet(f"{folder}/runs")
    return results_of(spark, folder, run_id)


def _known(spark, folder, table_name, asked):
    """States and keys of whole runs with the same rules."""
    runs = _read(spark, f"{folder}/runs")
    out = []
    for kind in ("states", "keys"):
        found = None if runs is None else _read(spark, f"{folder}/{kind}")
        if found is not None:
            whole = runs.select(F.col("run_id").alias("_run"))
            found = found.where((F.col("table_name") == table_name) & (F.col("ruleset") == asked)) \
                .join(whole, F.col("run").cast("string") == F.col("_run"), "left_semi").drop("run")
        out.append(found)
    return out


def _parts(spark, folder, kind, run_id, known, fresh):
    """The known states or keys with those of this run."""
    new = _read(spark, f"{folder}/{kind}/run={run_id}") if fresh else None
    if known is None or new is None:
        return known if new is None else new
    return known.unionByName(new)


def _usable(spark, schema, ruleset) -> dict[int, Measures]:
    """The rules that are merged from counts and moments, by number."""
    found = {i: m for i, r in enumerate(ruleset, 1)
             if not r.sql and not r.unique_key and (m := _measures(r, schema)) is not None}
    empty = spark.createDataFrame([], schema)
    fits = _analyzable(empty, {i: [f"{m.checked} AS c{i}", f"{m.violations} AS v{i}",
                                   f"{m.metric} AS m{i}"] for i, m in found.items()})
    return {i: found[i] for i in fits}


def _write_states(new, files, measures, table_name, asked, path) -> None:
    columns, rows = ["count(*) AS total"], []
    for i, m in measures.items():
        moment = _MOMENT.search(m.metric)
        x = f"CAST({moment[2]} AS DOUBLE)" if moment else "CAST(NULL AS DOUBLE)"
        columns += [f"{m.checked} AS c{i}", f"{m.violations} AS v{i}", f"count({x}) AS n{i}",
                    f"avg({x}) AS a{i}", f"var_pop({x}) * count({x}) AS q{i}"]
        rows.append(f"named_struct('rule_id', {i}, 'checked', c{i}, 'violations', v{i}, "
                    f"'n', n{i}, 'mean', a{i}, 'm2', q{i})")
    # The row of rule 0 says that a file was read, though it holds no row.
    rows.append("named_struct('rule_id', 0, 'checked', total, 'violations', CAST(NULL AS BIGINT), "
                "'n', 0L, 'mean', CAST(NULL AS DOUBLE), 'm2', CAST(NULL AS DOUBLE))")
    found = new.groupBy("_file").agg(*map(F.expr, columns)).selectExpr(
        "_file", "total", f"inline(array({', '.join(rows)}))")
    files.join(found, F.col("file") == F.col("_file"), "left").select(
        F.lit(table_name).alias("table_name"), F.lit(asked).alias("ruleset"), *_FILE,
        F.coalesce("rule_id", F.lit(0)).alias("rule_id"),
        F.coalesce("total", F.lit(0)).cast("long").alias("total"), "checked", "violations", "n",
        "mean", "m2").write.parquet(path)


def _write_keys(new, files, ruleset, schema, table_name, asked, path) -> None:
    """Distinct keys of each file with their rows, for each rule of uniqueness."""
    out = None
    for i, rule in enumerate(ruleset, 1):
        try:
            fields = [field_type(schema, c) for c in rule.unique_key]
        except KeyError:
            continue
        if not fields:
            continue
        present = F.expr(" AND ".join(f"{name(c)} IS NOT NULL" for c in rule.unique_key))
        key = F.to_json(F.struct(*[F.col(name(c)).alias(f"k{j}")
                                   for j, c in enumerate(rule.unique_key)]))
        one = new.where(present).groupBy("_file", key.alias("key")).agg(
            F.count("*").alias("rows")).withColumn("rule_id", F.lit(i))
        out = one if out is None else out.unionByName(one)
    if out is not None:
        out.join(files, F.col("file") == F.col("_file")).select(
            F.lit(table_name).alias("table_name"), F.lit(asked).alias("ruleset"), *_FILE,
            "rule_id", "key", "rows").write.parquet(path)


def _result_rows(spark, path, fmt, files, ruleset, schema, measures, table_name, run_id, states,
                 keys) -> DataFrame:
    here = states.join(files, _FILE, "left_semi")
    total = here.where("rule_id = 0").agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    first = here.groupBy("rule_id").agg(
        F.sum("checked").alias("checked"), F.sum("violations").alias("violations"),
        F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("mean")) / F.nullif(
            F.sum("n"), F.lit(0))).alias("centre"))
    # Squares are taken about the common mean, so nothing cancels out.
    spread = here.join(F.broadcast(first.select(F.col("rule_id").alias("_r"), "centre")),
                       F.col("rule_id") == F.col("_r")).groupBy("_r").agg(
        F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("centre")) ** 2).alias("m2"))
    merged = {r["rule_id"]: r for r in first.join(spread, F.col("rule_id") == F.col("_r"), "left")
              .collect()}  # a row per rule
    counts = {}
    if keys is not None:
        met = keys.join(files, _FILE, "left_semi").groupBy("rule_id", "key").agg(
            F.sum("rows").alias("rows"))
        counts = {r["rule_id"]: (r["t"], r["u"]) for r in met.groupBy("rule_id").agg(
            F.sum("rows").alias("t"), F.count("*").alias("u")).collect()}
    rows, frames = [], []
    for i, rule in enumerate(ruleset, 1):
        ids = (rule, table_name, run_id, i)
        try:
            if rule.sql is not None:
                frames.append(_free_sql(spark.read.schema(schema).format(fmt).load(path), rule, ids))
            elif rule.unique_key:
                for c in rule.unique_key:
                    field_type(schema, c)
                t, u = counts.get(i, (0, 0))
                rows.append(_result(*ids, f"{t}L", f"{t}L", f"{t - u}L",
                                    f"round(coalesce(try_divide({u}, {t}), 0), 4)",
                                    _PASSED.format(p=f"{t} = {u}")))
            elif i in measures:
                rows.append(_merged_result(ids, measures[i], merged.get(i), total))
            else:
                rows.append(_result(*ids))
        except (KeyError, TypeError, AnalysisException):
            rows.append(_result(*ids))
    if rows:
        frames.insert(0, spark.range(1).selectExpr(f"inline_outer(array({', '.join(rows)}))"))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out.select(*RESULT_COLUMNS)


def _merged_result(ids, m: Measures, row, total: int) -> str:
    """A rule's result with its aggregates replaced by the merged numbers."""
    checked = f"{row['checked'] if row else 0}L"
    violations = NO_COUNT if m.violations == NO_COUNT else f"{row['violations'] if row else 0}L"
    n = row["n"] if row else 0

    def number(value) -> str:
        return "CAST(NULL AS DOUBLE)" if value is None else f"CAST('{value!r}' AS DOUBLE)"

    mean = number(row["centre"] if n else None)
    spread = number((row["m2"] / (n - 1)) ** 0.5 if n > 1 else None)

    def put(text: str) -> str:
        text = _MOMENT.sub(lambda f: mean if f[1] == "avg" else spread, text)
        if m.violations != NO_COUNT:
            text = text.replace(m.violations, violations)
        return text.replace(m.checked, checked)

    return _result(*ids, f"{total}L", checked, violations, put(m.metric),
                   _PASSED.format(p=put(m.passed)))
