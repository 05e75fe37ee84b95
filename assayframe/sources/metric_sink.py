"""A sink that sends metrics in groups, as a Python data source for batches and streams.

Each task groups its own metrics, so nothing is shuffled, and writes them to a file of its own
try. Only when all tasks have ended does the driver write the commit that names their files;
readers follow commits. Files of tries that failed or were run twice are named by none. A
stream's commit carries the batch's number, so a batch that is run again replaces itself.

``df.write.format("metric_groups").mode("append").option("path", folder).save()``
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage,
)

from ..functions import fixed_values as fv

FORMAT = "metric_groups"
_GROUP = ("namespace string, metric_count int, metrics array<struct<name:string,value:double,"
          "unit:string,ts:timestamp,dimensions:map<string,string>>>")


def _open(path: str):
    """(file system, path in it) of a folder, on any store that Arrow reaches."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        uri = path if "://" in path else "file://" + path.removeprefix("file:")
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), path


def _put(folder: str, kind: str, name: str, text: str) -> None:
    """Writes a file whole: under another name first, so that no reader sees a part of it."""
    system, root = _open(folder)
    system.create_dir(f"{root}/{kind}", recursive=True)
    part = f"{root}/{kind}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        out.write(text.encode())
    system.move(part, f"{root}/{kind}/{name}")


@dataclass
class Written(WriterCommitMessage):
    """The file of one task, and what is in it."""

    file: str | None
    groups: int
    metrics: int


class _Groups:
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.size = int(options.get("size", fv.METRIC_BATCH))

    def write(self, rows: Iterator) -> Written:
        """Groups of at most ``size`` metrics of one namespace, in the order they come. A task
        holds one group per namespace and the lines of its file."""
        held: dict[str, list] = {}
        lines, count = [], 0

        def send(space: str) -> None:
            group = held.pop(space, [])
            if group:
                lines.append(json.dumps({"namespace": space, "metric_count": len(group),
                                         "metrics": group}, ensure_ascii=False))

        for row in rows:
            r = row.asDict(recursive=True)
            space = r.pop("namespace")
            if r.get("ts") is not None:
                r["ts"] = r["ts"].isoformat()
            held.setdefault(space, []).append(r)
            count += 1
            if len(held[space]) == self.size:
                send(space)
        for space in list(held):
            send(space)
        if not lines:
            return Written(None, 0, 0)
        name = f"{uuid.uuid4().hex}.json"
        _put(self.folder, "groups", name, "\n".join(lines) + "\n")
        return Written(name, len(lines), count)

    def commit_as(self, name: str, messages: list) -> None:
        done = [m for m in messages if m is not None and m.file]
        _put(self.folder, "commits", f"{name}.json", json.dumps({
            "commit": name, "files": [m.file for m in done],
            "groups": sum(m.groups for m in done), "metrics": sum(m.metrics for m in done)}) + "\n")

    def drop(self, messages: list) -> None:
        system, root = _open(self.folder)
        for m in messages:
            if m is not None and m.file:
                system.delete_file(f"{root}/groups/{m.file}")


class _BatchWriter(_Groups, DataSourceWriter):
    def commit(self, messages: list) -> None:
        self.commit_as(uuid.uuid4().hex, messages)

    def abort(self, messages: list) -> None:
        self.drop(messages)


class _StreamWriter(_Groups, DataSourceStreamWriter):
    def commit(self, messages: list, batchId: int) -> None:
        self.commit_as(f"batch-{batchId}", messages)

    def abort(self, messages: list, batchId: int) -> None:
        self.drop(messages)


class MetricGroups(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("groups of metrics are appended")
        return _BatchWriter(dict(self.options))

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:
        return _StreamWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(MetricGroups)


def write_metric_groups(metrics: DataFrame, folder: str, size: int = fv.METRIC_BATCH) -> None:
    """Appends metrics (namespace, name, value, unit, ts, dimensions) in groups."""
    register(metrics.sparkSession)
    metrics.select("namespace", "name", "value", "unit", "ts", "dimensions").write.format(
        FORMAT).mode("append").option("path", folder).option("size", size).save()


def read_metric_groups(spark: SparkSession, folder: str) -> DataFrame:
    """(namespace, metric_count, metrics) of all committed groups."""
    commits = spark.read.schema("files array<string>").json(f"{folder}/commits")
    named = commits.select(F.explode("files").alias("_file"))
    groups = spark.read.schema(_GROUP).json(f"{folder}/groups").withColumn(
        "_name", F.col("_metadata.file_name"))
    return groups.join(named, F.col("_name") == F.col("_file"), "left_semi").drop("_name")
