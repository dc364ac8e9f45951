"""Complaints of both sources -> features -> clusters -> daily marts -> summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from pulsemart.operators import clusters, features
from pulsemart.session import stage
from pulsemart.settings import DEFAULT_FEATURES, FeatureSettings, TrendSplit


def assigned_complaints(
    events: DataFrame, exports: DataFrame, cfg: FeatureSettings = DEFAULT_FEATURES
) -> DataFrame:
    """Raw social events and raw exports to complaints with cluster and priority."""
    unified = features.unified_complaints(events, exports)
    return clusters.assign_clusters(features.text_features(unified, cfg))


def complaint_clusters(
    assigned: DataFrame, literal_join: bool = False, staged: bool = True, columns: Sequence[str] | None = None
) -> DataFrame:
    """Complaints with the figures of their cluster.

    Rows and figures both need the classified complaints, so they are staged
    and every text is classified once.  ``columns`` names the complaint's own
    columns that are wanted; the rest is neither worked out nor written, but
    for what the figures need.
    """
    wanted = assigned if columns is None else assigned.select(*dict.fromkeys((*columns, *clusters.SUMMARY_INPUT)))
    rows = stage(wanted, "assigned") if staged else wanted
    return clusters.complaint_clusters(rows, clusters.cluster_summary(rows), literal_join)


def daily_stats(assigned: DataFrame, staged: bool = True) -> DataFrame:
    """Daily rows per cluster.

    Counting and sampling both read the classified complaints; staging their
    narrow form classifies every text once.
    """
    rows = clusters.trend_input(assigned)
    return clusters.daily_cluster_stats(stage(rows, "classified") if staged else rows)


def daily_trends(assigned: DataFrame, staged: bool = True) -> DataFrame:
    return clusters.daily_complaint_trends(daily_stats(assigned, staged))


def dashboard_summary(
    assigned: DataFrame, as_of: str, split: TrendSplit = TrendSplit(), staged: bool = True
) -> DataFrame:
    """30-day report; the daily mart feeds both halves, so it is staged too."""
    trends = daily_trends(assigned, staged)
    return clusters.dashboard_summary(stage(trends, "daily-trends") if staged else trends, as_of, split)
