"""Numeric building blocks: null-safe clamps, shares, indices, changes."""

from __future__ import annotations

from pyspark.sql import Column, Window, functions as F


def clamp(value: Column, low: float, high: float) -> Column:
    """Bounded value; null stays null (greatest/least would skip the null)."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def yes(condition: Column) -> Column:
    """Three-valued condition as a plain boolean: unknown is false."""
    return F.coalesce(condition, F.lit(False))


def share(condition: Column) -> Column:
    """Aggregate: share of rows where the condition holds (unknown counts as no)."""
    return F.avg(yes(condition).cast("double"))


def tally(condition: Column) -> Column:
    """Aggregate: number of rows where the condition holds."""
    return F.count_if(yes(condition))


def ratio(part: Column, whole: Column) -> Column:
    """Division that is null for an empty denominator."""
    return F.try_divide(part, whole)


def tone_index(mean_tone: Column) -> Column:
    """Mean tone in [-1, 1] as an index in [0, 100]."""
    return clamp((mean_tone + 1) * 50, 0.0, 100.0)


def change_pct(now: Column, before: Column) -> Column:
    """Percentage change; null unless the earlier value is positive."""
    return F.when(before > 0, (now - before) / before * 100)


def peer_percentile(metric: str, *peers: str) -> Column:
    """Percent rank among peers as 0-100."""
    return F.percent_rank().over(Window.partitionBy(*peers).orderBy(metric)) * 100


def label_number(label: Column, numbers: dict[str, float], default: float) -> Column:
    expr = F.lit(default)
    for name, value in reversed(list(numbers.items())):
        expr = F.when(label == name, F.lit(value)).otherwise(expr)
    return expr


def blended(a: Column, weight_a: Column, b: Column, weight_b: Column) -> Column:
    """Weighted mean of two values; null for zero total weight."""
    return ratio(a * weight_a + b * weight_b, weight_a + weight_b)
