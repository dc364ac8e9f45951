"""Small reference dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulsemart.settings import BRAND_ALIASES, BRAND_ROWS


def read_brand_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Dictionary file: CSV whose list columns are JSON arrays in quotes."""
    text = "brand_id string, brand_name string, aliases string, domains string, ticker string, hq_country string"
    rows = spark.read.schema(text).option("header", True).option("escape", '"').csv(path)
    return rows.withColumns(
        {name: F.from_json(name, "array<string>") for name in ("aliases", "domains")}
    )


def brand_dictionary(spark: SparkSession) -> DataFrame:
    """The built-in dictionary, as literal rows: the planner knows how small it is."""

    def listed(items) -> Column:
        return F.array(*[F.lit(i) for i in items])

    rows = [
        F.struct(
            F.lit(brand).alias("brand_id"), F.lit(name).alias("brand_name"), listed(aliases).alias("aliases"),
            listed(domains).alias("domains"), F.lit(ticker).alias("ticker"), F.lit(country).alias("hq_country"),
        )
        for brand, name, aliases, domains, ticker, country in BRAND_ROWS
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def canonical_brand(brand: Column) -> Column:
    """One identifier per brand: alternative spellings map to the dictionary's."""
    expr = brand
    for alias, target in BRAND_ALIASES.items():
        expr = F.when(brand == alias, F.lit(target)).otherwise(expr)
    return expr
