"""Session defaults and the staging helper shared by the plans."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

#: Settings the library is designed around; a cluster may override any of them.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Plans are built from many small expressions; do not record a call site for each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Aggregates with small map-like buffers stay hash-based for many groups per task.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8192",
    # Feeds are windowed on a subset of the join keys; let joins reuse that layout.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def build_session(app: str = "pulsemart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings (no web page, UTC clock)."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``.

    A cluster names a folder that every executor can reach.  Only a local
    session, where driver and executors are one process, may fall back to a
    temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="pulsemart-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back as a table.

    Used where several branches read one expensive result.  The written table
    survives lost executors and lets each branch read only its own columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Staging:
    """Staged tables of one write: ``with Staging(spark) as area`` deletes them once the write is done."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.path = spark, scratch_path(spark, "staging")

    def __enter__(self) -> Staging:
        return self

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_: object) -> None:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per session.

    Needed where it is not installed on every machine; functions that run in workers are found by import.
    """
    context = spark.sparkContext
    if getattr(context, "_pulsemart_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="pulsemart-"), "pulsemart.zip")
    with zipfile.ZipFile(target, "w") as bundle:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                bundle.write(path, os.path.join("pulsemart", os.path.relpath(path, root)))
    context.addPyFile(target)
    context._pulsemart_shipped = True
