"""Tables at rest: registry, partitioned marts, keyed upserts."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsemart.operators.versions import latest_version, merged_versions
from pulsemart.session import Staging
from pulsemart.sources.key_index import HOME, KeyIndex, folder_exists
from pulsemart.sources.layout import by_partition


def register_sources(spark: SparkSession, tables: Mapping[str, DataFrame | str]) -> None:
    """Logical name -> temp view, from a DataFrame or a Parquet path."""
    for name, table in tables.items():
        df = spark.read.parquet(table) if isinstance(table, str) else table
        df.createOrReplaceTempView(name)


def write_mart(
    df: DataFrame,
    path: str,
    partition: str = "date",
    cluster: Sequence[str] = ("brand_id", "country"),
) -> None:
    """Day-partitioned Parquet, sorted so that row-group statistics skip data.

    Only the partitions present in ``df`` are replaced.
    """
    (
        by_partition(df, partition)
        .sortWithinPartitions(partition, *cluster)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def replace_with_backup(df: DataFrame, path: str, backup_path: str) -> DataFrame:
    """Copy the table to ``backup_path``, then replace it by ``df``.

    ``df`` may be derived from the table itself: it is staged before the table
    is overwritten, so no input is read while it is being replaced.
    """
    spark = df.sparkSession
    spark.read.parquet(path).write.mode("overwrite").parquet(backup_path)
    with Staging(spark) as area:
        ready = area.stage(df, "replace")
        ready.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return spark.read.parquet(path)


#: Partition values that a read names one by one; beyond, a join picks the partitions.
NAMED_PARTITIONS = 2_000


def in_partitions(table: DataFrame, partition: str, wanted: DataFrame) -> DataFrame:
    """Rows of the partitions that ``wanted`` lists (one column), a missing value among them; others are not read."""
    listed = [r[0] for r in wanted.distinct().limit(NAMED_PARTITIONS + 1).collect()]
    if len(listed) > NAMED_PARTITIONS:
        values = wanted.toDF("_wanted").distinct()
        valued = table.join(values, F.col(partition) == F.col("_wanted"), "left_semi")
        missing = table.filter(F.col(partition).isNull())
        return valued.unionByName(missing) if values.filter("_wanted is null").head() else valued
    named = sorted(v for v in listed if v is not None)
    keep = F.col(partition).isin(named) if named else F.lit(False)
    return table.filter(keep | F.col(partition).isNull() if len(named) < len(listed) else keep)


def upsert(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    newest: Sequence[str],
    partition: str = "dt",
) -> None:
    """Keyed upsert of a partitioned Parquet table; repeating it changes nothing.

    A key keeps the partition of its first insert, also a missing one.  An index beside the table says where the batch's
    keys are, so only partitions that hold one of them, or receive a new one, are read and rewritten.  A stored row wins
    against an incoming one with equal ``newest`` columns.  Rows of keys that are not in the batch pass through without
    a shuffle when the batch is small enough for Spark to broadcast.

    The new partitions are complete beside the table before the first old one goes.  If the swap is interrupted, the
    next upsert (or ``finish_swaps``) ends it; if anything before fails, the table is as it was.
    """
    finish_swaps(spark, path)
    incoming = latest_version(updates, keys, newest)
    index = KeyIndex(spark, path, keys, partition)
    if not folder_exists(spark, path):
        with Staging(spark) as area:
            batch = area.stage(incoming, "batch")
            by_partition(batch, partition).write.mode("append").partitionBy(partition).parquet(path)
            index.add(batch, "overwrite")
        return
    table = spark.read.parquet(path)
    index.ensure(table)
    with Staging(spark) as area:
        # Read several times below; staged, its size is known.
        batch = area.stage(incoming, "batch")
        placed = area.stage(
            batch.join(index.homes(batch), list(keys), "left")
            .withColumn(partition, F.when(F.col(HOME).isNotNull(), F.col(f"{HOME}.value")).otherwise(F.col(partition))),
            "placed",
        )
        fresh = placed.filter(F.col(HOME).isNull())
        rows = placed.drop(HOME)
        affected = in_partitions(table, partition, rows.select(partition))
        _swap(spark, merged_versions(affected, rows, keys, newest), path, partition)
        index.add(fresh)


def append_new(spark: SparkSession, path: str, incoming: DataFrame, keys: Sequence[str], partition: str = "dt") -> None:
    """Insert only keys the table does not hold yet; of repeats in ``incoming``, one.

    Keys are looked up in the index, and in the partitions that the batch itself goes to: rows that an interrupted
    append has left there before it entered their keys are not added again.
    """
    finish_swaps(spark, path)
    fresh = latest_version(incoming, keys, [])
    index = KeyIndex(spark, path, keys, partition)
    with Staging(spark) as area:
        batch = area.stage(fresh, "batch")
        if not folder_exists(spark, path):
            by_partition(batch, partition).write.mode("append").partitionBy(partition).parquet(path)
            index.add(batch, "overwrite")
            return
        table = spark.read.parquet(path)
        index.ensure(table)
        unknown = batch.join(index.homes(batch).select(*keys), list(keys), "left_anti")
        near = in_partitions(table, partition, batch.select(partition)).select(*keys)
        ready = area.stage(unknown.join(near, list(keys), "left_anti"), "append")
        by_partition(ready, partition).write.mode("append").partitionBy(partition).parquet(path)
        index.add(unknown)


def _swap(spark: SparkSession, rows: DataFrame, path: str, partition: str) -> None:
    """Replace the partitions of ``rows``: written beside the table first, then moved into place."""
    pending = f"{path.rstrip('/')}.pending-{uuid.uuid4().hex}"
    by_partition(rows, partition).write.partitionBy(partition).parquet(f"{pending}/new")
    _put_in_place(spark, pending, path)


def _put_in_place(spark: SparkSession, pending: str, path: str) -> None:
    """Move complete partition folders into the table, one after the other; those they replace go aside first.

    Nothing is copied.  Started again after an interruption, it goes on with the folders that are left.
    """
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{pending}/new")
    files = new.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = new.suffix("-replaced")
    files.mkdirs(old)
    for found in files.listStatus(new):
        if found.isDirectory():
            name = found.getPath().getName()
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, name)
            if files.exists(target) and not files.rename(target, old.suffix(f"/{name}")):
                raise OSError(f"cannot move {target} aside")
            if not files.rename(found.getPath(), target):
                raise OSError(f"cannot move {name} into {path}")
    spark.catalog.refreshByPath(path)
    _delete(spark, pending)


def finish_swaps(spark: SparkSession, path: str) -> None:
    """Put partitions in place that an interrupted upsert had written completely; drop incomplete ones."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.pending-*")
    files = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in files.globStatus(pattern) or []:
        pending = found.getPath().toString()
        if folder_exists(spark, f"{pending}/new/_SUCCESS"):
            _put_in_place(spark, pending, path)
        else:
            _delete(spark, pending)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
