"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

# Runtime re-planning: joins on a hot key are split even when a later operator
# wants the join's partitioning.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A task's share follows from sizes alone, not from a fixed number of partitions: what a task groups or sorts
    # in memory stays the same while the tables grow.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "512",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "16m",
}


def build_session(master: str = "local[*]", app: str = "evgraph", **settings: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **settings,
    }.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach; a local one only in local mode."""
    sc = spark.sparkContext
    setting = "spark.checkpoint.dir"
    configured = spark.conf.get(setting, None) or sc.getConf().get(setting) or sc.getCheckpointDir()
    if configured:
        return configured
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="evgraph-"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage."""
    sc, folder = df.sparkSession.sparkContext, shared_dir(df.sparkSession).rstrip("/").removeprefix("file:")
    if not (sc.getCheckpointDir() or "").removeprefix("file:").startswith(folder):
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for tables handed between jobs. They lie in
    one folder per application, which is deleted when the application ends."""
    folder = f"{shared_dir(spark).rstrip('/')}/evgraph-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


_meanwhile: list[list[str]] = []


@contextmanager
def passing(spark: SparkSession, keep: int = 0) -> Iterator[list[str]]:
    """Deletes the tables written meanwhile when a step ends, save those it takes off the list of their paths
    and the last ``keep``, which go with the step around this one."""
    _meanwhile.append([])
    try:
        yield _meanwhile[-1]
        for _ in range(keep):
            path = _meanwhile[-1].pop()
            for paths in _meanwhile[-2:-1]:
                paths.append(path)
    finally:
        for path in map(spark._jvm.org.apache.hadoop.fs.Path, _meanwhile.pop()):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` as a parquet table in the shared folder: computed once however often it is
    read, pruned by column, of known size to the optimizer, and not lost with an executor."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    for paths in _meanwhile[-1:]:
        paths.append(path)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


HELD_ROWS = 500_000  # of a table of short rows that each task may hold


def held(table: DataFrame, rows: int = HELD_ROWS) -> DataFrame:
    """A written table as a side of joins that comes to the other side, if a count finds it short; a longer one is
    left to the optimizer. Sessions may set the size below which Spark does so by itself far lower."""
    return F.broadcast(table) if table.count() <= rows else table
