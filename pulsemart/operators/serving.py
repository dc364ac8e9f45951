"""Rows behind the dashboard: overview, pages, tiles, rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsemart.functions.scores import tally

SEVERITY_RANK = {"high": 3, "medium": 2, "low": 1}


def cluster_overview(summary: DataFrame) -> DataFrame:
    """Cluster rows as the overview shows them."""
    return summary.select(
        "cluster_name", "cluster_description", "cluster_priority",
        F.col("complaint_count").alias("total_complaints"),
        F.col("days_with_complaints").alias("days_active"),
        "avg_severity_score", "reddit_complaints", "cfpb_complaints",
        F.col("first_complaint_date").alias("first_seen"),
        F.col("last_complaint_date").alias("last_seen"),
    )


def overview_cards(overview: DataFrame) -> DataFrame:
    """Overview with relative volume, priority label and severity band.

    The overview has a fixed maximum of clusters x priorities rows, so one
    window over all of them is small.
    """
    largest = F.max("total_complaints").over(Window.partitionBy())
    severity = F.col("avg_severity_score")
    return overview.withColumns(
        {
            "relative_volume_pct": F.round(F.try_divide(F.col("total_complaints"), largest) * 100, 1),
            "priority_label": priority_label(F.col("cluster_priority")),
            "severity_band": F.when(severity > 0.7, "high").when(severity > 0.4, "medium").otherwise("low"),
            "severity_pct": F.round(severity * 100, 1),
        }
    )


def priority_label(priority: Column) -> Column:
    return F.when(priority == 1, "Critical").when(priority == 2, "High").when(priority == 3, "Medium").otherwise("Low")


def kpi_tiles(overview: DataFrame) -> DataFrame:
    """Totals over all clusters; severity is the plain mean of the clusters."""
    critical = F.col("cluster_priority") == 1
    return overview.agg(
        F.sum("total_complaints").alias("total_complaints"),
        F.coalesce(F.sum(F.when(critical, F.col("total_complaints"))), F.lit(0)).alias("critical_complaints"),
        tally(critical).alias("critical_clusters"),
        F.avg("avg_severity_score").alias("avg_severity"),
        F.max("days_active").alias("active_days"),
    )


def overview_totals(overview: DataFrame) -> DataFrame:
    return overview.agg(
        F.count(F.lit(1)).alias("total_clusters"),
        tally(F.col("cluster_priority") == 1).alias("critical_issues"),
        F.sum("reddit_complaints").alias("reddit_posts"),
        F.sum("cfpb_complaints").alias("cfpb_reports"),
    )


def trend_rows(trends: DataFrame) -> DataFrame:
    """Daily rows as the chart shows them."""
    return trends.select(
        "complaint_date", "cluster_name", "cluster_description", "daily_complaint_count",
        "avg_severity_score", "reddit_count", "cfpb_count", "sample_complaints",
        F.round(F.col("avg_severity_score") * 100).cast("bigint").alias("severity_percentage"),
    )


def date_rollup(trends: DataFrame) -> DataFrame:
    return trends.groupBy("complaint_date").agg(
        F.sum("daily_complaint_count").alias("total_count"),
        F.sum("reddit_count").alias("reddit_count"),
        F.sum("cfpb_count").alias("cfpb_count"),
    )


def cluster_distribution(trends: DataFrame) -> DataFrame:
    return trends.groupBy("cluster_name").agg(F.sum("daily_complaint_count").alias("value")).select(
        F.replace("cluster_name", F.lit("_"), F.lit(" ")).alias("name"), "value", "cluster_name"
    )


def top_categories(trends: DataFrame, limit: int = 5) -> DataFrame:
    return cluster_distribution(trends).orderBy(F.col("value").desc(), "cluster_name").limit(limit)


def severity_rank(level: Column) -> Column:
    rank = F.lit(0)
    for name, value in SEVERITY_RANK.items():
        rank = F.when(level == name, F.lit(value)).otherwise(rank)
    return rank


def recent_samples(trends: DataFrame) -> DataFrame:
    """Sample complaints of all days, one row each."""
    return trends.select(
        F.explode("sample_complaints").alias("c"), "complaint_date", "cluster_name",
        "cluster_description", "avg_severity_score",
    ).select("c.*", "complaint_date", "cluster_name", "cluster_description", "avg_severity_score")


def newest_samples(trends: DataFrame, limit: int = 15, severity: str | None = None) -> DataFrame:
    """Newest samples, gravest first within a day; optionally one severity."""
    rows = recent_samples(trends)
    if severity:
        rows = rows.filter(F.col("severity_level") == severity)
    return rows.orderBy(
        F.col("complaint_date").desc(), severity_rank(F.col("severity_level")).desc(),
        "cluster_name", "complaint_id",
    ).limit(limit)


def _of_cluster(complaints: DataFrame, cluster: str | None) -> DataFrame:
    return complaints if cluster in (None, "all") else complaints.filter(F.col("cluster_name") == cluster)


#: A complaint as the pages show it.
PAGE_COLUMNS = (
    "complaint_id", "source_type", "brand_id", "complaint_text", "complaint_date", "cluster_name", "severity_level", "source_detail",
)


def page_rows(complaints: DataFrame) -> DataFrame:
    """Complaints with the columns of a page, whole texts included; text features only decide the cluster."""
    return complaints.select(*PAGE_COLUMNS)


def newest_first() -> list[Column]:
    """The order of complaint pages."""
    return [F.col("complaint_date").desc(), severity_rank(F.col("severity_level")).desc(), F.col("complaint_id").asc()]


def complaint_page(
    complaints: DataFrame, cluster: str | None = None, page: int = 1, page_size: int = 50
) -> DataFrame:
    """One page of complaints, newest first.

    Offset and limit become a bounded top-n: each task keeps only the rows up
    to the end of the page.  For deep pages, write the rows once with
    ``sources.page_index``, which opens a page's own range alone.
    """
    return (
        _of_cluster(complaints, cluster)
        .orderBy(*newest_first())
        .offset((page - 1) * page_size)
        .limit(page_size)
    )


def page_envelope(
    complaints: DataFrame, cluster: str | None = None, page: int = 1, page_size: int = 50
) -> DataFrame:
    return envelope(_of_cluster(complaints, cluster).agg(F.count(F.lit(1)).alias("total_count")), page, page_size)


def envelope(total: DataFrame, page: int, page_size: int) -> DataFrame:
    """Page numbers around a row with ``total_count``, counted or from a page index."""
    return (
        total.withColumn("total_pages", F.ceil(F.col("total_count") / page_size))
        .select(
            F.lit(page).alias("page"),
            F.lit(page_size).alias("page_size"),
            "total_count", "total_pages",
            (F.lit(page) < F.col("total_pages")).alias("has_next_page"),
            F.lit(page > 1).alias("has_previous_page"),
        )
    )


def latest_scores(scores: DataFrame, limit: int = 10) -> DataFrame:
    """The newest day's best brands first."""
    return (
        scores.select("brand_id", "date", "country", "composite_score", "composite_rank")
        .orderBy(F.col("date").desc(), F.col("composite_score").desc(), "brand_id", "country")
        .limit(limit)
    )


def severity_counts(complaints: DataFrame) -> DataFrame:
    level = F.col("severity_level")
    return complaints.agg(*[tally(level == name).alias(name) for name in SEVERITY_RANK])
