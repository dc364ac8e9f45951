"""Feeds -> daily rollups -> brand metrics -> composite score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from pulsemart.operators import daily, raw, scoring
from pulsemart.settings import (
    DEFAULT_DAILY, REDDIT_TONE, TWITTER_TONE, DailySettings, DateRange, ToneLexicon, Weights,
)
from pulsemart.sources.dimensions import canonical_brand


@dataclass(frozen=True)
class ScoreFeeds:
    twitter: DataFrame
    reddit: DataFrame
    trends: DataFrame
    complaints: DataFrame
    brands: DataFrame


def _aligned(feed: DataFrame) -> DataFrame:
    """Feeds spell some brands differently; the dictionary's spelling wins."""
    return feed.withColumn("brand_id", canonical_brand(F.col("brand_id")))


def twitter_table(
    feed: DataFrame, days: DateRange | None = None, tone: ToneLexicon = TWITTER_TONE,
    cfg: DailySettings = DEFAULT_DAILY,
) -> DataFrame:
    return daily.twitter_daily(raw.twitter_posts(_aligned(feed), days), tone, cfg)


def reddit_table(
    feed: DataFrame, days: DateRange | None = None, tone: ToneLexicon = REDDIT_TONE,
    cfg: DailySettings = DEFAULT_DAILY,
) -> DataFrame:
    return daily.reddit_daily(raw.reddit_messages(_aligned(feed), days), tone, cfg)


def trends_table(
    feed: DataFrame, days: DateRange | None = None, cfg: DailySettings = DEFAULT_DAILY,
    calendar_lag: bool = False, top_keywords: bool = True,
) -> DataFrame:
    return daily.trends_daily(raw.trends_timeseries(_aligned(feed), days), cfg, calendar_lag, top_keywords)


def complaints_table(
    feed: DataFrame, days: DateRange | None = None, cfg: DailySettings = DEFAULT_DAILY
) -> DataFrame:
    return daily.complaints_daily(raw.complaints(_aligned(feed), days), cfg)


def brand_metrics(
    feeds: ScoreFeeds,
    days: DateRange | None = None,
    literal_regions: bool = False,
    twitter_tone: ToneLexicon = TWITTER_TONE,
    reddit_tone: ToneLexicon = REDDIT_TONE,
    cfg: DailySettings = DEFAULT_DAILY,
) -> DataFrame:
    return scoring.brand_daily_metrics(
        twitter_table(feeds.twitter, days, twitter_tone, cfg),
        reddit_table(feeds.reddit, days, reddit_tone, cfg),
        trends_table(feeds.trends, days, cfg, top_keywords=False),
        complaints_table(feeds.complaints, days, cfg),
        feeds.brands,
        literal_regions,
    )


def brand_score(
    feeds: ScoreFeeds, weights: Weights = Weights(), reviews: DataFrame | None = None, **options
) -> DataFrame:
    return scoring.composite_score(brand_metrics(feeds, **options), weights, reviews=reviews)
