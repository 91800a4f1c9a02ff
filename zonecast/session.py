"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def build_session(app_name: str = "zonecast", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on.

    UTC keeps stored wall-clock times as they are; AQE sizes shuffle partitions, splits skewed
    join partitions and switches join strategies from real sizes at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # What a task reads after a shuffle; AQE merges small partitions up to it and splits skewed ones.
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.compression.codec": "zstd",
        # Plans here have hundreds of columns; recording the Python line of each one is slow.
        "spark.sql.dataFrameQueryContext.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read: the session's ``spark.checkpoint.dir``.

    Only a local session without that setting (tests) falls back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="zonecast-")
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), "zonecast", f"{label}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Used where a result is consumed by more than one branch of a plan: the expensive prefix
    (a scan of raw trips) then runs once, the lineage is cut, and a lost executor costs only
    a re-read. Parquet keeps column pruning and filter pushdown for the consumers.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

