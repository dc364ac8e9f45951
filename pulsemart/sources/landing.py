"""Landing zone: newline-delimited JSON, one folder per day or per day and brand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsemart.settings import DateRange
from pulsemart.sources.layout import by_partition

_CORRUPT = "_corrupt_line"


def parse_lines(lines: DataFrame, schema: str) -> DataFrame:
    """JSON text in ``value`` as typed columns; blank lines and non-JSON lines are skipped."""
    parsed = F.from_json(
        "value", f"{schema}, {_CORRUPT} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT},
    )
    return (
        lines.filter(F.trim("value") != "")
        .withColumn("_j", parsed)
        .filter(F.col("_j").isNotNull() & F.col(f"_j.{_CORRUPT}").isNull())
        .select("_j.*", "dt")
        .drop(_CORRUPT)
    )


def read_landing(
    spark: SparkSession, path: str, schema: str, days: DateRange | None = None
) -> DataFrame:
    """Read day folders (``dt=YYYY-MM-DD``); lines that are not JSON are skipped.

    A day range prunes whole folders.
    """
    lines = spark.read.schema("value string, dt date").text(path)
    return parse_lines(in_days(lines, days) if days else lines, schema)


def in_days(df: DataFrame, days: DateRange, column: str = "dt") -> DataFrame:
    if days.start:
        df = df.filter(F.col(column) >= F.lit(days.start).cast("date"))
    if days.end:
        df = df.filter(F.col(column) <= F.lit(days.end).cast("date"))
    return df


def write_landing(df: DataFrame, path: str, ts: str = "ts_event") -> None:
    """Append compressed JSON lines under ``dt=<event day>``."""
    (
        by_partition(df.withColumn("dt", F.to_date(ts)), "dt")
        .write.mode("append")
        .partitionBy("dt")
        .option("compression", "gzip")
        .json(path)
    )


def write_brand_days(df: DataFrame, path: str, ts: str = "ts_event") -> None:
    """Older layout ``date=…/brand_id=…``: a rerun replaces the folders it touches."""
    (
        by_partition(df.withColumn("date", F.to_date(ts)), "date", "brand_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "brand_id")
        .json(path)
    )
