"""Session settings and the shared folder jobs may write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators are written for. Shuffle parallelism is left to the cluster:
#: adaptive execution merges small partitions and splits skewed ones.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_local_dirs: dict[str, str] = {}


def session(app: str = "assayframe", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; on a cluster the
    folder has to be named, since a machine-local one is not visible to executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="assayframe-")
    return _local_dirs[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of this session hold 4 MB, or one longer row, unless it has a limit of its own.

    By default a batch is bounded by 10,000 rows and 64 MB, and the JVM and the Python worker of
    each task hold it several times over, beyond the heap. The setting is read when a frame runs,
    so it stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, DEFAULTS[key])


def settle(df: DataFrame, name: str = "stage", codec: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts lineage in a way that survives the loss of executors, and pins values that
    depend on how rows were split between tasks. ``codec``: the files' compression, that of
    the session if None. Snappy holds whole pages beyond the heap, so rows of many MB are better
    written with one that streams.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)
