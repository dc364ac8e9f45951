"""Pages of a sorted list without sorting it for each page.

The rows lie in ranges of the sort order, a folder each, numbered within their range.  A small directory says how many
rows of a group lie before each range, so any page, however deep, names its range (or two) and its row numbers.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from pulsemart.session import Staging

#: Rows of a range.
RANGE_ROWS = 100_000
RANGE, ROW, GROUP, PLACE = "_range", "_row", "_group", "place"


def _group(column: str | None) -> Column:
    return (F.col(column) if column else F.lit(None)).cast("string")


def write_pages(
    rows: DataFrame, path: str, order: Sequence[Column], group: str | None = None, range_rows: int = RANGE_ROWS
) -> None:
    """Write ``rows`` for paging in ``order``, within each value of ``group`` or, without one, over all rows.

    The order should end with a key: rows that are equal in it get an arbitrary place, the same for every reader, and
    stay in one range.  A missing group is a group of its own; a hot one is cut into ranges like all rows.  An empty
    table gives empty pages.  Columns named as this module's own are refused.  The directory has a row per range and
    group in it, and is summed up by one task where there is no group: ten million rows of it fit.
    """
    taken = {RANGE, ROW, GROUP, PLACE} & {c.lower() for c in rows.columns}
    if taken:
        raise ValueError(f"reserved column names: {sorted(taken)}")
    spark = rows.sparkSession
    keys = [*([F.col(group)] if group else []), *order]
    with Staging(spark) as area:
        ready = area.stage(rows, "pages")
        ranges = max(1, -(-ready.count() // range_rows))
        placed = (
            ready.repartitionByRange(ranges, *keys)
            .sortWithinPartitions(*keys)
            .withColumn(RANGE, F.spark_partition_id())
            # The low bits of this id count the rows of a task.
            .withColumn(ROW, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        )
        placed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(RANGE).parquet(f"{path}/rows")
    about = json.dumps({"schema": rows.schema.jsonValue(), "group": group})
    spark.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")
    earlier = Window.partitionBy(GROUP).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    (
        PageIndex(spark, path).rows.groupBy(RANGE, _group(group).alias(GROUP))
        .agg(F.count(F.lit(1)).alias("rows"), F.min(ROW).alias("first"))
        .withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
        .write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/directory")
    )


class PageIndex:
    """Written pages, opened for reading."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        about = json.loads(spark.read.text(f"{path}/about").head()[0])
        self.group = about["group"]
        stored = StructType.fromJson(about["schema"]).add(ROW, LongType()).add(RANGE, IntegerType())
        self.rows = spark.read.schema(stored).parquet(f"{path}/rows")

    def _directory(self, value: object = None) -> DataFrame:
        entries = self.spark.read.parquet(f"{self.path}/directory")
        return entries.filter(F.col(GROUP).eqNullSafe(F.lit(value).cast("string")))

    def page(self, number: int, size: int, value: object = None) -> DataFrame:
        """Page ``number`` (from 1) of the group ``value``; its ranges alone are read."""
        start = (number - 1) * size
        # Every entry found holds a row of the page, so there are at most ``size``.
        found = self._directory(value).filter((F.col("before") < start + size) & (F.col("before") + F.col("rows") > start)).collect()
        wanted = F.lit(False)
        for e in found:
            low = e["first"] + max(start - e.before, 0)
            high = e["first"] + min(start + size - e.before, e.rows) - 1
            wanted = wanted | ((F.col(RANGE) == e[RANGE]) & F.col(ROW).between(low, high))
        return self.rows.filter(wanted).orderBy(RANGE, ROW).drop(RANGE, ROW)

    def total(self, value: object = None) -> DataFrame:
        """One row with ``total_count`` of the group, from the directory."""
        return self._directory(value).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("total_count"))

    def placed(self) -> DataFrame:
        """All rows with their ``place`` (from 1) in their group."""
        entries = self.spark.read.parquet(f"{self.path}/directory")
        own = self.rows.withColumn(GROUP, _group(self.group))
        same = (own[RANGE] == entries[RANGE]) & own[GROUP].eqNullSafe(entries[GROUP])
        place = F.col("before") + F.col(ROW) - F.col("first") + 1
        return own.join(entries, same).select(*(own[c] for c in own.columns if c not in (RANGE, ROW, GROUP)), place.alias(PLACE))
