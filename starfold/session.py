"""Spark session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job in this package wants. Joins carry no broadcast hints: Spark
# picks a broadcast only below autoBroadcastJoinThreshold, measured at run time by AQE.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_SHIPPED: set[str] = set()


def _ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for the Python functions in it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="starfold-code-"), "starfold_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    _ship_package(spark)
    return spark


def get_spark(master: str | None = None, app: str = "starfold", **conf: str) -> SparkSession:
    """Create (or reuse) a session; `conf` entries override the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, from spark.checkpoint.dir.

    Only where the executors run on this machine a temporary folder takes its place if unset.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current is None:
        if not configured and sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set; it must name a folder all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="starfold-"))
        current = sc.getCheckpointDir()
    return configured or current


def work_root(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables, below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/starfold-{spark.sparkContext.applicationId}"


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one written intermediate table."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"


def clear_work(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; frames built on them can no longer run."""
    drop_work(spark, work_root(spark))


def drop_work(spark: SparkSession, path: str) -> None:
    """Delete one intermediate table."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df: DataFrame, label: str, release: bool = False) -> DataFrame:
    """Write an intermediate result below the shared folder and read it back.

    For results that several branches of a plan need: Spark would recompute each branch from the
    source scans. The written table cuts the lineage, survives lost executors and carries exact
    sizes for the join choices that follow. `release` as in `released_shuffles`.
    """
    return df.sparkSession.read.parquet(write_work(df, label, release))


def write_work(df: DataFrame, label: str, release: bool = False) -> str:
    """Write an intermediate result below the shared folder and return its path; `release` as in `released_shuffles`."""
    path = work_path(df.sparkSession, label)
    with released_shuffles(df.sparkSession, release):
        df.write.option("compression", "zstd").parquet(path)
    return path


@contextmanager
def released_shuffles(spark: SparkSession, release: bool = True) -> Iterator[None]:
    """Shuffle files of the writes inside are deleted as soon as each has ended, instead of when the driver happens
    to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    if release:
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
