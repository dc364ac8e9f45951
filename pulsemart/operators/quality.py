"""Declarative checks and their report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class NotNull:
    column: str

    @property
    def name(self) -> str:
        return f"not_null:{self.column}"

    def broken(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AcceptedValues:
    column: str
    values: tuple

    @property
    def name(self) -> str:
        return f"accepted_values:{self.column}"

    def broken(self) -> Column:
        return ~F.col(self.column).isin(list(self.values))


@dataclass(frozen=True)
class AcceptedRange:
    column: str
    low: float | None = None
    high: float | None = None

    @property
    def name(self) -> str:
        return f"accepted_range:{self.column}"

    def broken(self) -> Column:
        value, out = F.col(self.column), F.lit(False)
        if self.low is not None:
            out = out | (value < self.low)
        if self.high is not None:
            out = out | (value > self.high)
        return out


@dataclass(frozen=True)
class Unique:
    """No two rows share the key; rows with a null in a one-column key are not compared."""

    columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"unique:{','.join(self.columns)}"


RowCheck = NotNull | AcceptedValues | AcceptedRange


def run_checks(df: DataFrame, table: str, checks: Sequence[RowCheck | Unique]) -> DataFrame:
    """One row per check with the number of failures.

    All row checks share one aggregation; each key check is one more, which
    counts keys that occur more than once.
    """
    rows = [c for c in checks if not isinstance(c, Unique)]
    parts = []
    if rows:
        counted = df.agg(*[F.count_if(c.broken()).alias(f"c{i}") for i, c in enumerate(rows)])
        listed = F.explode(
            F.array(
                *[F.struct(F.lit(c.name).alias("name"), F.col(f"c{i}").alias("n")) for i, c in enumerate(rows)]
            )
        )
        parts.append(
            counted.select(listed.alias("r")).select(
                F.col("r.name").alias("check_name"), F.col("r.n").alias("failures")
            )
        )
    for check in checks:
        if isinstance(check, Unique):
            keyed = df.filter(F.col(check.columns[0]).isNotNull()) if len(check.columns) == 1 else df
            repeated = keyed.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("n"))
            parts.append(
                repeated.agg(F.count_if(F.col("n") > 1).alias("failures")).select(
                    F.lit(check.name).alias("check_name"), "failures"
                )
            )
    return reduce(DataFrame.unionByName, parts).select(
        F.lit(table).alias("table_name"), "check_name", "failures", (F.col("failures") == 0).alias("passed")
    )


# Checks of the feeds and of the score table.
TWITTER_CHECKS = (
    NotNull("brand_id"), NotNull("tweet_id"), Unique(("tweet_id",)), NotNull("ts_event"), NotNull("text"),
    NotNull("collected_at"),
)
REDDIT_CHECKS = (
    NotNull("brand_id"), NotNull("reddit_id"), Unique(("reddit_id",)), NotNull("ts_event"), NotNull("type"),
    AcceptedValues("type", ("post", "comment")),
)
TRENDS_CHECKS = (
    NotNull("brand_id"), NotNull("keyword"), NotNull("ts_event"), NotNull("value"),
    AcceptedRange("value", 0, 100),
)
COMPLAINT_CHECKS = (
    NotNull("brand_id"), NotNull("complaint_id"), Unique(("complaint_id",)), NotNull("ts_event"),
    AcceptedRange("severity_score", 0, 1),
)
SCORE_CHECKS = (
    NotNull("brand_id"), NotNull("brand_name"), NotNull("date"), NotNull("country"),
    NotNull("composite_score"), AcceptedRange("composite_score", 0, 100), NotNull("composite_rank"),
    AcceptedRange("social_score", 0, 100), AcceptedRange("search_score", 0, 100),
    AcceptedRange("complaints_score", 0, 100),
    AcceptedValues("risk_category", ("Healthy", "Low Risk", "Medium Risk", "High Risk")),
    AcceptedValues("trend_direction", ("Improving", "Stable", "Declining")),
    NotNull("calc_version"), Unique(("brand_id", "date", "country")),
)
