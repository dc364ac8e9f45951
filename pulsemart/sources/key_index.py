"""Which partition of a table holds a key: an append-only index beside the table.

A key keeps the partition it was first inserted into, so entries are only ever added.  They lie in folders by a hash of
the key; a batch opens the folders of its own keys alone, and never the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulsemart.sources.layout import by_partition

#: Folders by key.
BUCKETS = 16
HOME = "_home"


def folder_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


class KeyIndex:
    """The index of one table.  ``HOME`` is a struct with the partition's value, so a missing value is an entry too."""

    def __init__(self, spark: SparkSession, table_path: str, keys: Sequence[str], partition: str) -> None:
        self.spark, self.keys, self.partition = spark, list(keys), partition
        self.path = f"{table_path.rstrip('/')}.keys"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*(F.col(k).cast("string") for k in self.keys)), F.lit(BUCKETS)).cast("int")

    def exists(self) -> bool:
        return folder_exists(self.spark, f"{self.path}/_SUCCESS")

    def add(self, rows: DataFrame, mode: str = "append") -> None:
        """Enter the keys of new rows with their partition; entering one twice changes nothing."""
        entries = rows.select(*self.keys, F.struct(F.col(self.partition).alias("value")).alias(HOME), self._bucket().alias("_bucket"))
        by_partition(entries, "_bucket").write.mode(mode).option("partitionOverwriteMode", "static").partitionBy("_bucket").parquet(self.path)

    def ensure(self, table: DataFrame) -> None:
        """Build the index of a table that was written without one: the only time that all keys are read."""
        if not self.exists():
            self.add(table, "overwrite")

    def homes(self, batch: DataFrame) -> DataFrame:
        """The keys of a batch that the table holds, each with ``HOME``."""
        folders = [r[0] for r in batch.select(self._bucket()).distinct().collect()]  # at most BUCKETS
        entries = self.spark.read.parquet(self.path).filter(F.col("_bucket").isin(folders)).select(*self.keys, HOME)
        return entries.join(batch.select(*self.keys), self.keys, "left_semi").dropDuplicates(self.keys)
