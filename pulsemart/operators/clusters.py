"""Rule clusters of complaints with daily, weekly and 30-day summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsemart.functions.plan import computed_once
from pulsemart.functions.scores import label_number, tally
from pulsemart.operators.features import flag_name
from pulsemart.settings import (
    CLUSTER_DEFAULT, CLUSTER_RULES, PRIORITY_DEFAULT, PRIORITY_RULES, SEVERITY_AS_NUMBER, TrendSplit,
)

# The description follows from the name, so it is added after grouping.
CLUSTER_KEYS = ("cluster_name", "cluster_priority")
#: What the cluster figures are made from.
SUMMARY_INPUT = (*CLUSTER_KEYS, "source_detail", "source_type", "complaint_date", "severity_level")
MENTIONS = ("account", "card", "loan", "fee", "fraud", "service", "error")
PREVIEW_CHARS = 200
SAMPLES = 5
COMMON_SOURCES = 10


def _all_present(features: tuple[str, ...]) -> Column:
    expr = F.lit(True)
    for f in features:
        expr = expr & (F.col(flag_name(f)) == 1)
    return expr


def cluster_name() -> Column:
    """Name of the first rule whose features are all present."""
    expr = F.lit(CLUSTER_DEFAULT[0])
    for features, name, _ in reversed(CLUSTER_RULES):
        expr = F.when(_all_present(features), F.lit(name)).otherwise(expr)
    return expr


def cluster_description(name: Column) -> Column:
    """Description by name; one rule table drives both."""
    texts = {name_: text for _, name_, text in CLUSTER_RULES}
    texts[CLUSTER_DEFAULT[0]] = CLUSTER_DEFAULT[1]
    pairs = [F.lit(x) for item in texts.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), name)


def cluster_priority() -> Column:
    expr = F.lit(PRIORITY_DEFAULT)
    for features, label, priority in reversed(PRIORITY_RULES):
        rule = _all_present(features)
        if label is not None:
            rule = rule & (F.col("severity_level") == label)
        expr = F.when(F.coalesce(rule, F.lit(False)), F.lit(priority)).otherwise(expr)
    return expr


def severity_number() -> Column:
    return label_number(F.col("severity_level"), SEVERITY_AS_NUMBER, 0.0)


def assign_clusters(features: DataFrame) -> DataFrame:
    """Add cluster and priority; filters and joins on them never match the texts again."""
    labels = F.struct(cluster_name().alias("cluster_name"), cluster_priority().alias("cluster_priority"))
    return described(computed_once(features, "_labels", labels).select("*", "_labels.*").drop("_labels"))


def described(df: DataFrame) -> DataFrame:
    return df.withColumn("cluster_description", cluster_description(F.col("cluster_name")))


def cluster_summary(assigned: DataFrame) -> DataFrame:
    """One row per cluster and priority.

    The complaints are read once: they are first counted per cluster, source
    detail and day, and everything else comes from those counts.  Only the
    first source names, found by rank, are collected.
    """
    counted = assigned.groupBy(*CLUSTER_KEYS, "source_detail", "complaint_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(severity_number()).alias("severity"),
        tally(F.col("source_type") == "reddit").alias("reddit"),
        tally(F.col("source_type") == "cfpb").alias("cfpb"),
    )
    detail = F.col("source_detail")
    by_name = Window.partitionBy(*CLUSTER_KEYS).orderBy(detail.asc_nulls_last())
    named = F.when(F.col("_place") <= COMMON_SOURCES, detail)
    return described(
        counted.withColumn("_place", F.dense_rank().over(by_name))
        .groupBy(*CLUSTER_KEYS)
        .agg(
            F.sum("n").alias("complaint_count"),
            F.count_distinct("complaint_date").alias("days_with_complaints"),
            (F.sum("severity") / F.sum("n")).alias("avg_severity_score"),
            F.sum("reddit").alias("reddit_complaints"),
            F.sum("cfpb").alias("cfpb_complaints"),
            F.min("complaint_date").alias("first_complaint_date"),
            F.max("complaint_date").alias("last_complaint_date"),
            F.sort_array(F.collect_set(named)).alias("common_sources"),
        )
    )


def complaint_clusters(assigned: DataFrame, summary: DataFrame, literal_join: bool = False) -> DataFrame:
    """Every complaint with the figures of its cluster.

    The summary has at most clusters x priorities rows, fixed by the rule
    table, so it is broadcast.  ``literal_join`` matches on the name alone,
    which repeats a complaint once per priority of its cluster.
    """
    figures = summary.select(
        *CLUSTER_KEYS,
        F.col("complaint_count").alias("cluster_total_complaints"),
        F.col("days_with_complaints").alias("cluster_days_active"),
        F.col("avg_severity_score").alias("cluster_avg_severity"),
        F.col("reddit_complaints").alias("cluster_reddit_count"),
        F.col("cfpb_complaints").alias("cluster_cfpb_count"),
        F.col("first_complaint_date").alias("cluster_first_date"),
        F.col("last_complaint_date").alias("cluster_last_date"),
        F.col("common_sources").alias("cluster_common_sources"),
    )
    if literal_join:
        figures = figures.drop("cluster_priority")
        return assigned.join(F.broadcast(figures), "cluster_name")
    return assigned.join(F.broadcast(figures), list(CLUSTER_KEYS))


def trend_input(assigned: DataFrame) -> DataFrame:
    """The columns the daily mart needs: previews instead of whole texts."""
    return assigned.select(
        "complaint_id", "source_type", "complaint_date", "severity_level", "source_detail",
        F.substring("complaint_text", 1, PREVIEW_CHARS).alias("complaint_preview"),
        F.length("complaint_text").alias("text_length"),
        *[flag_name(f"{m}_terms") for m in MENTIONS],
        *CLUSTER_KEYS,
    )


def daily_cluster_stats(rows: DataFrame) -> DataFrame:
    """Counts, severity, mentions and five samples per day and cluster.

    ``rows`` comes from :func:`trend_input`.  Samples are ranked first, which
    keeps five rows per task and group before the shuffle.
    """
    keys = ("complaint_date", *CLUSTER_KEYS)
    stats = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("daily_complaint_count"),
        F.count_distinct("complaint_id").alias("unique_complaints"),
        F.avg(severity_number()).alias("avg_severity_score"),
        tally(F.col("source_type") == "reddit").alias("reddit_count"),
        tally(F.col("source_type") == "cfpb").alias("cfpb_count"),
        *[F.sum(flag_name(f"{m}_terms")).alias(f"{m}_mentions") for m in MENTIONS],
    )
    grave = F.when(F.col("severity_level") == "high", 1).when(F.col("severity_level") == "medium", 2).otherwise(3)
    order = Window.partitionBy(*keys).orderBy(grave, F.col("text_length").desc(), "complaint_id")
    sample = ("complaint_id", "source_type", "complaint_preview", "severity_level", "source_detail")
    samples = (
        rows.select(*keys, *sample, "text_length")
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= SAMPLES)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("place", *sample))).alias("ranked"))
        .select(*keys, _without_place("ranked", sample).alias("sample_complaints"))
    )
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys]
    both = stats.alias("s").join(samples.alias("p"), same, "left")
    return described(both.select("s.*", "p.sample_complaints"))


def _without_place(column: str, fields: tuple[str, ...]) -> Column:
    return F.transform(column, lambda x: F.struct(*[x[f].alias(f) for f in fields]))


def daily_complaint_trends(stats: DataFrame) -> DataFrame:
    """Daily cluster rows with the day's ranking and the week's figures.

    ``stats`` holds at most clusters x priorities rows per day, so the day and
    week figures are window aggregates over it and the complaints are read
    once.
    """
    day = Window.partitionBy("complaint_date")
    week = Window.partitionBy("week_start", "cluster_name")
    entry = ("cluster_name", "cluster_description", "daily_complaint_count", "avg_severity_score",
             "sample_complaints")
    ranked = F.array_sort(
        F.collect_list(
            F.struct(
                (-F.col("daily_complaint_count")).alias("k1"),
                (-F.col("avg_severity_score")).alias("k2"),
                F.col("cluster_name").alias("k3"),
                F.col("cluster_priority").alias("k4"),
                *entry,
            )
        ).over(day)
    )
    return stats.withColumn("week_start", F.trunc("complaint_date", "week")).withColumns(
        {
            "daily_active_clusters": F.size(F.collect_set("cluster_name").over(day)),
            "total_daily_complaints": F.sum("daily_complaint_count").over(day),
            "overall_daily_severity": F.avg("avg_severity_score").over(day),
            "daily_cluster_ranking": F.transform(
                F.slice(ranked, 1, 10), lambda x: F.struct(*[x[f].alias(f) for f in entry])
            ),
            "day_of_week": F.dayofweek("complaint_date"),
            "day_name": F.date_format("complaint_date", "EEEE"),
            "weekly_complaint_count": F.sum("daily_complaint_count").over(week),
            "weekly_avg_severity": F.avg("avg_severity_score").over(week),
            "days_active_in_week": F.size(F.collect_set("complaint_date").over(week)),
        }
    )


def daily_severity(stats: DataFrame) -> DataFrame:
    """Severity per day: the published mean of cluster means beside the mean over complaints."""
    count = F.col("daily_complaint_count")
    return stats.groupBy("complaint_date").agg(
        F.sum(count).alias("total_daily_complaints"),
        F.avg("avg_severity_score").alias("overall_daily_severity"),
        (F.sum(count * F.col("avg_severity_score")) / F.sum(count)).alias("weighted_daily_severity"),
    )


def weekly_trends(stats: DataFrame) -> DataFrame:
    """Monday weeks per cluster."""
    return stats.groupBy(
        F.trunc("complaint_date", "week").alias("week_start"), "cluster_name", "cluster_description"
    ).agg(
        F.sum("daily_complaint_count").alias("weekly_complaint_count"),
        F.avg("avg_severity_score").alias("weekly_avg_severity"),
        F.count_distinct("complaint_date").alias("days_active_in_week"),
        F.min("complaint_date").alias("first_complaint_in_week"),
        F.max("complaint_date").alias("last_complaint_in_week"),
    )


def recent(trends: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    return trends.filter(F.col("complaint_date") >= F.date_sub(F.lit(as_of).cast("date"), days))


def trend_direction(split: TrendSplit = TrendSplit()) -> Column:
    """Recent daily rate against the earlier one.

    As published, the recent part spans ``days`` + 1 dates but is divided by
    ``days``; ``balanced`` uses equal spans and true counts.
    """
    active = F.col("days_active")
    if split.balanced:
        now = F.col("_recent_strict") / split.days
        before = F.try_divide(F.col("_early_strict"), F.col("_early_days"))
    else:
        now = F.col("_recent") / float(split.days)
        before = F.col("_early") / F.greatest(active - split.days, F.lit(1))
    return (
        F.when(active < split.min_active_days, "insufficient_data")
        .when(now > before * split.rising, "increasing")
        .when(now < before * split.falling, "decreasing")
        .otherwise("stable")
    )


def cluster_trend_summary(period: DataFrame, split: TrendSplit = TrendSplit()) -> DataFrame:
    """One row per cluster over the recent period.

    A group has at most one row per day of the period, so its seven latest
    samples can be collected and cut.
    """
    last = F.max("complaint_date").over(Window.partitionBy(*CLUSTER_KEYS))
    count, day = F.col("daily_complaint_count"), F.col("complaint_date")
    edge = F.date_sub("_last", split.days)
    newest_first = F.reverse(
        F.array_sort(
            F.collect_list(F.struct("complaint_date", "daily_complaint_count", "sample_complaints"))
        )
    )
    strict = F.date_sub("_last", split.days - 1)
    return (
        period.withColumn("_last", last)
        .groupBy(*CLUSTER_KEYS, "cluster_description")
        .agg(
            F.count_distinct("complaint_date").alias("days_active"),
            F.sum(count).alias("total_complaints"),
            F.avg(count).alias("avg_daily_complaints"),
            F.avg("avg_severity_score").alias("avg_severity"),
            F.max(count).alias("peak_daily_complaints"),
            F.min(day).alias("first_seen"),
            F.max(day).alias("last_seen"),
            F.sum(F.when(day >= edge, count).otherwise(0)).alias("_recent"),
            F.sum(F.when(day < edge, count).otherwise(0)).alias("_early"),
            F.sum(F.when(day >= strict, count).otherwise(0)).alias("_recent_strict"),
            F.sum(F.when(day < strict, count).otherwise(0)).alias("_early_strict"),
            F.nullif(F.datediff(F.max("_last"), F.min(day)) + 1 - split.days, F.lit(0)).alias("_early_days"),
            F.slice(newest_first, 1, 7).alias("recent_daily_samples"),
        )
        .withColumn("trend_direction", trend_direction(split))
        .select(
            *CLUSTER_KEYS, "cluster_description", "days_active", "total_complaints", "avg_daily_complaints", "avg_severity",
            "peak_daily_complaints", "first_seen", "last_seen", "trend_direction", "recent_daily_samples",
        )
    )


def daily_summary(period: DataFrame, days: int = 30) -> DataFrame:
    """One row per day with its three largest clusters, latest days first."""
    sample = ("complaint_id", "source_type", "complaint_preview", "severity_level")
    entry = ("cluster_name", "cluster_description", "daily_complaint_count", "avg_severity_score",
             "top_complaints")
    first_three = F.transform(
        F.slice("sample_complaints", 1, 3), lambda x: F.struct(*[x[f].alias(f) for f in sample])
    )
    ranked = F.array_sort(
        F.collect_list(
            F.struct(
                (-F.col("daily_complaint_count")).alias("k1"),
                F.col("cluster_name").alias("k2"),
                F.col("cluster_priority").alias("k3"),
                *entry,
            )
        )
    )
    return (
        period.withColumn("top_complaints", first_three)
        .groupBy("complaint_date")
        .agg(
            F.sum("daily_complaint_count").alias("daily_total_complaints"),
            F.count_distinct("cluster_name").alias("daily_active_clusters"),
            F.avg("avg_severity_score").alias("daily_overall_severity"),
            F.transform(
                F.slice(ranked, 1, 3), lambda x: F.struct(*[x[f].alias(f) for f in entry])
            ).alias("daily_top_clusters"),
        )
        .orderBy(F.col("complaint_date").desc())
        .limit(days)
    )


def dashboard_summary(trends: DataFrame, as_of: str, split: TrendSplit = TrendSplit()) -> DataFrame:
    """Cluster rows and day rows of the last 30 days in one report."""
    period = recent(trends, as_of)
    clusters = cluster_trend_summary(period, split).withColumn("report_type", F.lit("cluster_summary"))
    days = daily_summary(period).withColumn("report_type", F.lit("daily_summary"))
    return (
        clusters.unionByName(days, allowMissingColumns=True)
        .withColumn("generated_at", F.lit(as_of).cast("timestamp_ntz"))
        .orderBy(
            "report_type",
            F.coalesce("cluster_priority", F.lit(999)),
            F.coalesce("complaint_date", F.lit("1900-01-01").cast("date")).desc(),
        )
    )
