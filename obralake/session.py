"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "obralake", **conf: str) -> SparkSession:
    """Session with the settings the library expects; `conf` adds or overrides settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # AQE merges partitions but never makes more: start with enough for large inputs.
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if master and master.startswith("local"):
        # Few cores and small inputs: every core gets a share, and partitions are as many as asked for.
        del settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
        settings["spark.sql.adaptive.coalescePartitions.minPartitionSize"] = "64k"
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; local sessions may lack one."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if named:
        if not current:
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    root = tempfile.mkdtemp(prefix="obralake-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts lineage so that the loss of an executor never recomputes what lies before, and gives
    Catalyst the true size: a small result is broadcast by its threshold, a large one is not.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(*tables: DataFrame) -> None:
    """Remove what `store` has written of the tables that these are read from, once nothing reads it any more.

    Files outside the shared folder stay.
    """
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        shared = path(checkpoint_root(spark)).toUri().getPath().rstrip("/") + "/"
        for found in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            folder = path(found)
            if folder.toUri().getPath().startswith(shared):
                folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
