"""Helpers that keep costly expressions from being evaluated twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters read instead of recomputing.

    A filter on a projected column is normally pushed below the projection,
    which evaluates its expression a second time.  Passing the value through a
    one-element explode stops that, at the price of one array per row.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
