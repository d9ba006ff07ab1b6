"""Session settings and shared storage used by every job."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are planned around. Skew handling and partition
# coalescing stay with AQE; the UTC zone only affects how timestamps print,
# because every calendar function in this package is zone independent.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Stages that enrich and score rows compile to long methods, which the JVM
    # would otherwise leave uncompiled.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "cellwatch", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only when the cluster names none (a local test session) is a temporary
    folder taken, and then it also becomes the session's checkpoint folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="cellwatch-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def ensure_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable in this session."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, never reused between calls."""
    return os.path.join(shared_dir(spark), "cellwatch", f"{name}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with files that every executor can read, so losing an
    executor costs only the tasks it held. Sizes of the result are known to the
    planner.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
