"""Operational and analytical reports over feeds and complaints."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsemart.functions.scores import change_pct, ratio
from pulsemart.settings import AlertSettings


def freshness(feeds: Mapping[str, DataFrame], as_of: Column, column: str = "collected_at") -> DataFrame:
    """Newest collection time per feed and whole hours since then."""
    rows = [
        df.agg(F.max(column).alias("last_update")).select(F.lit(name).alias("source_table"), "last_update")
        for name, df in feeds.items()
    ]
    stacked = reduce(DataFrame.unionByName, rows)
    hours = F.timestamp_diff("HOUR", F.date_trunc("hour", "last_update"), F.date_trunc("hour", as_of))
    return stacked.withColumn("hours_since_update", hours).orderBy(
        F.col("hours_since_update").desc(), "source_table"
    )


def synced_today(feeds: Mapping[str, DataFrame], today: Column, column: str = "collected_at") -> DataFrame:
    """Rows and newest load of the day per feed."""
    rows = [
        df.filter(F.to_date(column) == today)
        .agg(F.count(F.lit(1)).alias("rows_today"), F.max(column).alias("last_sync"))
        .select(F.lit(name).alias("source"), "rows_today", "last_sync")
        for name, df in feeds.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def top_states(complaints: DataFrame, limit: int = 10) -> DataFrame:
    return (
        complaints.filter(F.col("state").isNotNull())
        .groupBy("state")
        .agg(F.count(F.lit(1)).alias("complaints"))
        .orderBy(F.col("complaints").desc(), "state")
        .limit(limit)
    )


def share_of_total(complaints: DataFrame, column: str) -> DataFrame:
    """Counts and percentage of the total per value of a low-cardinality column."""
    counts = complaints.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("complaints"))
    total = F.sum("complaints").over(Window.partitionBy())
    return counts.select(
        F.lit(column).alias("dimension"), "value", "complaints",
        (ratio(F.col("complaints"), total) * 100).alias("share_pct"),
    )


def peak_days(stats: DataFrame, limit: int = 3, clusters: int = 3) -> DataFrame:
    """The busiest days with their largest clusters.

    ``stats`` has one row per day and cluster, so a day's rows are few.
    """
    by_cluster = stats.groupBy("complaint_date", "cluster_name").agg(
        F.sum("daily_complaint_count").alias("n")
    )
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "cluster_name", "n")))
    return (
        by_cluster.groupBy("complaint_date")
        .agg(F.sum("n").alias("total_complaints"), F.slice(ranked, 1, clusters).alias("_top"))
        .withColumn(
            "top_clusters",
            F.transform("_top", lambda x: F.struct(x["cluster_name"].alias("cluster_name"), x["n"].alias("n"))),
        )
        .drop("_top")
        .orderBy(F.col("total_complaints").desc(), "complaint_date")
        .limit(limit)
    )


def topic_weeks(events: DataFrame, day: str = "event_date") -> DataFrame:
    """Weekly volume and severity per topic with the change to the week before."""
    weekly = (
        events.select(F.explode("topics").alias("topic"), F.trunc(day, "week").alias("week_start"), "severity")
        .groupBy("topic", "week_start")
        .agg(F.count(F.lit(1)).alias("volume"), F.avg("severity").alias("avg_severity"))
    )
    series = Window.partitionBy("topic").orderBy("week_start")
    return weekly.withColumn("wow_change_pct", change_pct(F.col("volume"), F.lag("volume", 1).over(series)))


def topic_shares(events: DataFrame, day: str = "event_date") -> DataFrame:
    """Share of each topic among a brand's tagged mentions of a day."""
    counts = (
        events.select("brand_id", F.col(day).alias("date"), F.explode("topics").alias("topic"))
        .groupBy("brand_id", "date", "topic")
        .agg(F.count(F.lit(1)).alias("mentions"))
    )
    total = F.sum("mentions").over(Window.partitionBy("brand_id", "date"))
    return counts.withColumn("topic_share", ratio(F.col("mentions"), total))


def share_of_voice(points: DataFrame) -> DataFrame:
    """Brand-with-category search volume against category volume, in percent."""
    kind, value = F.col("keyword_type"), F.col("value")
    combined = kind.isin("brand_category", "category_brand")
    return (
        points.groupBy("brand_id", "date")
        .agg(
            F.sum(F.when(combined, value)).alias("brand_category_searches"),
            F.sum(F.when(kind == "category", value)).alias("category_searches"),
        )
        .withColumn(
            "share_of_voice",
            ratio(F.col("brand_category_searches"), F.col("category_searches")) * 100,
        )
    )


# Intent tier of a keyword type.
INTENT = {"brand_category": "high", "category_brand": "high", "category": "medium", "brand": "low"}


def intent_tiers(points: DataFrame) -> DataFrame:
    tier = F.lit("unknown")
    for kind, name in INTENT.items():
        tier = F.when(F.col("keyword_type") == kind, F.lit(name)).otherwise(tier)
    return (
        points.withColumn("intent", tier)
        .groupBy("brand_id", "intent")
        .agg(
            F.sum("value").alias("searches"),
            F.avg("value").alias("avg_interest"),
            F.count(F.lit(1)).alias("points"),
        )
    )


def alerts(daily: DataFrame, cfg: AlertSettings = AlertSettings()) -> DataFrame:
    """Days whose volume jumped or whose severity is high.

    ``daily`` has one row per brand and day (date, complaints, severity).
    """
    series = Window.partitionBy("brand_id").orderBy("date")
    jump = change_pct(F.col("complaints"), F.lag("complaints", 1).over(series))
    return (
        daily.withColumn("volume_change_pct", jump)
        .withColumns(
            {
                "volume_alert": F.coalesce(F.col("volume_change_pct") >= cfg.volume_increase, F.lit(False)),
                "severity_alert": F.coalesce(F.col("severity") >= cfg.severity, F.lit(False)),
            }
        )
        .filter("volume_alert or severity_alert")
    )
