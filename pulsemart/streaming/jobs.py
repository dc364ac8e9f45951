"""Structured Streaming jobs.

Each job reads what is new and stops (``availableNow``), which is how the daily
schedule runs them; with another trigger they run continuously.  Checkpoints
live in the folder the caller names.  Late and repeated events are settled by
key in the tables themselves, never dropped by a watermark.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsemart.functions.scores import change_pct
from pulsemart.session import Staging
from pulsemart.settings import AlertSettings
from pulsemart.sources.landing import parse_lines
from pulsemart.sources.rollups import Rollup
from pulsemart.sources.tables import append_new, in_partitions, upsert, write_mart

def landing_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """New landing files as a stream; lines that are not JSON are skipped."""
    reader = spark.readStream.schema("value string, dt date")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return parse_lines(reader.text(path), schema)


def _run(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, mode: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )


def append_unique(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str] = ("event_id",), ts: str = "ts_event"
) -> StreamingQuery:
    """Every event once, however late it or a repeat of it arrives.

    The table itself remembers the keys, so no watermark is needed, and no row
    is dropped for being late.  A batch that is run again adds nothing.
    """

    def work(batch: DataFrame, _: int) -> None:
        append_new(batch.sparkSession, path, batch.withColumn("dt", F.to_date(ts)), keys)

    return _run(stream, work, checkpoint, "append")


def upsert_events(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], newest: Sequence[str]
) -> StreamingQuery:
    """Keyed upsert per batch; replaying a batch gives the same table."""

    def work(batch: DataFrame, _: int) -> None:
        upsert(batch.sparkSession, path, batch, keys, newest)

    return _run(stream, work, checkpoint, "append")


@dataclass(frozen=True)
class DailyTables:
    """Where a daily rollup keeps its events and its daily rows."""

    events: str
    daily: str


def _record_days(
    spark: SparkSession, area: Staging, batch: DataFrame, tables: DailyTables, value: Column, key: str, ts: str, brand: str
) -> DataFrame:
    """Add a batch's events, then count the days they belong to again; returns these days."""
    rows = area.stage(batch.withColumn("dt", F.to_date(ts)), "events")
    append_new(spark, tables.events, rows, [key])
    days = area.stage(rows.select("dt").distinct(), "days")
    stored = in_partitions(spark.read.parquet(tables.events), "dt", days.filter("dt is not null"))
    counted = stored.groupBy(F.col("dt").alias("date"), F.col(brand).alias("brand_id")).agg(
        F.count(F.lit(1)).alias("volume"), F.avg(value).alias("mean_value")
    )
    write_mart(counted.withColumn("dt", F.col("date")), tables.daily, "dt", ("brand_id",))
    return days


def publish_daily(
    stream: DataFrame,
    tables: DailyTables,
    checkpoint: str,
    value: Column,
    key: str = "event_id",
    ts: str = "ts_event",
    brand: str = "brand_id",
) -> StreamingQuery:
    """Volume and mean value per brand and day, from all events so far.

    Events are kept by key; each batch counts only the days it touches again,
    from the table, so a late event or a repeat changes a day as it should.
    """

    def work(batch: DataFrame, _: int) -> None:
        with Staging(batch.sparkSession) as area:
            _record_days(batch.sparkSession, area, batch, tables, value, key, ts, brand)

    return _run(stream, work, checkpoint, "append")


@dataclass(frozen=True)
class RollupColumns:
    """What a kept rollup counts: the key of an event, its time, its brand and its member."""

    key: str = "event_id"
    ts: str = "ts_event"
    brand: str = "brand_id"
    member: str = "author"


ROLLUP_GROUPS = ("date", "brand_id")


def publish_rollup(
    stream: DataFrame, path: str, checkpoint: str, value: Column, columns: RollupColumns = RollupColumns(), compact_every: int = 24
) -> StreamingQuery:
    """Volume, mean, deviation and members per brand and day, merged from a part per batch.

    Unlike ``publish_daily`` it keeps no events: a batch reads its own rows and the index entries of their keys, and
    writes its own part.  ``Rollup(spark, path, ROLLUP_GROUPS).read()`` gives the figures.
    """
    groups = {"date": F.to_date(columns.ts), "brand_id": F.col(columns.brand)}

    def work(batch: DataFrame, number: int) -> None:
        rollup = Rollup(batch.sparkSession, path, ROLLUP_GROUPS)
        rollup.add_events(number, batch, [columns.key], groups, value, F.col(columns.member))
        if (number + 1) % compact_every == 0:
            rollup.compact()

    return _run(stream, work, checkpoint, "append")


def compared_days(daily: DataFrame, cfg: AlertSettings = AlertSettings()) -> DataFrame:
    """Each daily row beside the day before, with the change and whether it calls for an alert.

    The previous day is found by an equi-join on brand and date, so it works on
    the few days a batch touched as well as on the whole table.
    """
    before = daily.select(
        "brand_id", F.date_add("date", 1).alias("date"), F.col("volume").alias("previous_volume")
    )
    return (
        daily.join(before, ["brand_id", "date"], "left")
        .withColumn("change_pct", change_pct(F.col("volume"), F.col("previous_volume")))
        .withColumn("alert", F.coalesce(F.col("change_pct") >= cfg.volume_increase, F.lit(False)))
        .select("brand_id", "date", "volume", "previous_volume", "change_pct", "alert")
    )


def spike_alerts(daily: DataFrame, cfg: AlertSettings = AlertSettings()) -> DataFrame:
    """Rows of the published daily table whose volume jumped over the day before."""
    return compared_days(daily, cfg).filter("alert").drop("alert")


def alert_on_spikes(
    stream: DataFrame,
    tables: DailyTables,
    alert_path: str,
    checkpoint: str,
    value: Column,
    cfg: AlertSettings = AlertSettings(),
    key: str = "event_id",
    ts: str = "ts_event",
    brand: str = "brand_id",
) -> StreamingQuery:
    """Publish daily rows and the alerts of the days that a batch can change.

    A day is compared again when it, or the day before it, was touched.  Its
    folder then holds a row for each brand with a comparison, with ``alert``
    set or not, so an alert that no longer holds is replaced.
    """

    def work(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        with Staging(spark) as area:
            days = _record_days(spark, area, batch, tables, value, key, ts, brand)
            near = days.select(F.explode(F.array(F.date_sub("dt", 1), F.col("dt"), F.date_add("dt", 1))).alias("dt"))
            stored = in_partitions(spark.read.parquet(tables.daily), "dt", near.filter("dt is not null")).drop("dt")
            due = days.select(F.explode(F.array(F.col("dt"), F.date_add("dt", 1))).alias("date")).distinct()
            compared = compared_days(stored, cfg).join(due, "date", "left_semi")
            write_mart(compared.withColumn("dt", F.col("date")), alert_path, "dt", ("brand_id",))

    return _run(stream, work, checkpoint, "append")
