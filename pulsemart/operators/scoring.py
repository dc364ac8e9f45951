"""Four feeds joined per brand, day and country; composite score on top."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsemart.functions.scores import blended, change_pct, clamp, yes
from pulsemart.settings import (
    DEFAULT_SCORE, DEFAULT_WEIGHTS, FourPartWeights, ScoreSettings, Weights,
)

KEYS = ("brand_id", "date", "country")

# Feed column -> metric column.
TWITTER_METRICS = {
    "posts": "twitter_posts", "authors": "twitter_authors", "engagements": "twitter_engagements",
    "sentiment_avg": "twitter_sentiment_avg", "volume_index": "twitter_volume_index",
    "sentiment_index": "twitter_sentiment_index", "toxicity_rate": "twitter_toxicity_rate",
    "min_sample_size_met": "twitter_sample_ok", "anomaly_flag": "twitter_anomaly",
}
REDDIT_METRICS = {
    "messages": "reddit_messages", "unique_authors": "reddit_authors", "score_sum": "reddit_score_sum",
    "sentiment_avg": "reddit_sentiment_avg", "volume_index": "reddit_volume_index",
    "sentiment_index": "reddit_sentiment_index", "toxicity_rate": "reddit_toxicity_rate",
    "min_sample_size_met": "reddit_sample_ok", "anomaly_flag": "reddit_anomaly",
}
TRENDS_METRICS = {
    "rsv_avg": "trends_rsv_avg", "brand_rsv_avg": "trends_brand_rsv_avg",
    "category_rsv_avg": "trends_category_rsv_avg", "rsv_trend_7d": "trends_7d_change",
    "rsv_trend_28d": "trends_28d_change", "visibility_index": "trends_visibility_index",
    "min_sample_size_met": "trends_sample_ok", "anomaly_flag": "trends_anomaly",
}
COMPLAINT_METRICS = {
    "complaints": "cfpb_complaints", "timely_rate": "cfpb_timely_rate",
    "dispute_rate": "cfpb_dispute_rate", "severity_avg": "cfpb_severity_avg",
    "complaints_index": "cfpb_complaints_index",
    "response_quality_index": "cfpb_response_quality_index",
    "min_sample_size_met": "cfpb_sample_ok", "anomaly_flag": "cfpb_anomaly",
}
COUNTS = (
    "twitter_posts", "twitter_authors", "twitter_engagements",
    "reddit_messages", "reddit_authors", "reddit_score_sum", "cfpb_complaints",
)
PUBLISHED = (
    "twitter_posts", "twitter_authors", "twitter_engagements", "twitter_sentiment_avg",
    "reddit_messages", "reddit_authors", "reddit_score_sum", "reddit_sentiment_avg",
    "trends_rsv_avg", "trends_brand_rsv_avg", "trends_category_rsv_avg", "trends_7d_change",
    "trends_28d_change", "cfpb_complaints", "cfpb_timely_rate", "cfpb_dispute_rate",
    "cfpb_severity_avg", "social_volume_index", "social_sentiment_index",
    "trends_visibility_index", "cfpb_complaints_index", "cfpb_response_quality_index",
    "twitter_toxicity_rate", "reddit_toxicity_rate", "min_sample_size_met", "anomaly_flag",
    "data_freshness_ok",
)


def country_level_trends(trends: DataFrame) -> DataFrame:
    """One trends row per brand, day and country.

    The country's own row wins; without one, regions are averaged by their
    number of points.  A flag holds if it holds for any region.
    """
    own = F.col("region") == F.col("country")
    points = F.col("data_points").cast("double")
    measures = ("rsv_avg", "brand_rsv_avg", "category_rsv_avg", "rsv_trend_7d", "rsv_trend_28d",
                "visibility_index")

    def pick(name: str) -> Column:
        value = F.col(name)
        known = F.when(value.isNotNull(), points)
        mean = F.try_divide(F.sum(value * points), F.sum(known))
        return F.when(F.bool_or(own), F.max(F.when(own, value))).otherwise(mean).alias(name)

    def flag(name: str) -> Column:
        return F.coalesce(F.bool_or(F.when(own, F.col(name))), F.bool_or(name)).alias(name)

    return trends.groupBy(*KEYS).agg(
        *[pick(m) for m in measures], flag("min_sample_size_met"), flag("anomaly_flag")
    )


def brand_daily_metrics(
    twitter: DataFrame,
    reddit: DataFrame,
    trends: DataFrame,
    complaints: DataFrame,
    brands: DataFrame,
    literal_regions: bool = False,
) -> DataFrame:
    """All feeds side by side, one row per brand, day and country.

    Every feed holds one row per key, so the left joins on the union of all
    keys are one aggregation over the stacked feeds: each feed is computed once
    and no separate list of keys is built.  ``literal_regions`` keeps one row
    per trends region instead of the country-level value.
    """
    feeds = [(twitter, TWITTER_METRICS), (reddit, REDDIT_METRICS), (complaints, COMPLAINT_METRICS)]
    if literal_regions:
        feeds.append((trends, {}))
    else:
        feeds.append((country_level_trends(trends), TRENDS_METRICS))
    # Rows with an unknown key are listed but match nothing, as in an equi-join.
    known = F.col("date").isNotNull() & F.col("country").isNotNull() & F.col("brand_id").isNotNull()
    stacked = None
    for feed, names in feeds:
        part = feed.select(
            *KEYS, *[F.when(known, F.col(src)).alias(dst) for src, dst in names.items()]
        )
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    metrics = [c for c in stacked.columns if c not in KEYS]
    side_by_side = stacked.groupBy(*KEYS).agg(*[F.max(c).alias(c) for c in metrics])
    if literal_regions:
        regional = trends.select(*KEYS, *[F.col(s).alias(d) for s, d in TRENDS_METRICS.items()])
        side_by_side = side_by_side.join(regional, list(KEYS), "left")
    named = side_by_side.withColumns({c: F.coalesce(c, F.lit(0)) for c in COUNTS}).join(
        brands.select("brand_id", "brand_name"), "brand_id", "left"
    )
    return combine_social(named).select("brand_id", "brand_name", "date", "country", *PUBLISHED)


def combine_social(metrics: DataFrame) -> DataFrame:
    """Volume-weighted social indices and the combined quality flags."""
    tw, rd = F.col("twitter_posts"), F.col("reddit_messages")
    tw_vol, rd_vol = F.col("twitter_volume_index"), F.col("reddit_volume_index")
    tw_tone, rd_tone = F.col("twitter_sentiment_index"), F.col("reddit_sentiment_index")
    volume = (
        F.when((tw > 0) & (rd > 0), blended(tw_vol, tw, rd_vol, rd))
        .when(tw > 0, tw_vol)
        .when(rd > 0, rd_vol)
    )
    tone = F.when(
        tw_tone.isNotNull() & rd_tone.isNotNull(), blended(tw_tone, tw, rd_tone, rd)
    ).otherwise(F.coalesce(tw_tone, rd_tone))
    social_ok = F.col("twitter_sample_ok") | F.col("reddit_sample_ok")
    other_ok = F.col("trends_sample_ok") | F.col("cfpb_sample_ok")
    unusual = (
        F.col("twitter_anomaly") | F.col("reddit_anomaly") | F.col("trends_anomaly") | F.col("cfpb_anomaly")
    )
    return metrics.withColumns(
        {
            "social_volume_index": volume,
            "social_sentiment_index": tone,
            "min_sample_size_met": yes(social_ok & other_ok),
            "anomaly_flag": yes(unusual),
            "data_freshness_ok": F.lit(True),
        }
    )


def composite_score(
    metrics: DataFrame,
    weights: Weights = DEFAULT_WEIGHTS,
    cfg: ScoreSettings = DEFAULT_SCORE,
    reviews: DataFrame | None = None,
    calendar_lag: bool = False,
) -> DataFrame:
    """Weighted 0-100 score with ranks, changes, risk and notes.

    Missing components count as neutral.  ``reviews`` (brand_id, date, country,
    reviews_customer_score, reviews_employee_score) replaces the neutral
    review components where it has a row.
    """
    base = metrics
    if reviews is not None:
        base = base.join(
            reviews.select(*KEYS, "reviews_customer_score", "reviews_employee_score"), list(KEYS), "left"
        )
    else:
        empty = F.lit(None).cast("double")
        base = base.withColumns({"reviews_customer_score": empty, "reviews_employee_score": empty})
    neutral = F.lit(cfg.neutral)
    parts = base.select(
        "brand_id", "brand_name", "date", "country",
        F.coalesce("social_sentiment_index", neutral).alias("social_score"),
        F.coalesce("trends_visibility_index", neutral).alias("search_score"),
        F.coalesce("cfpb_complaints_index", neutral).alias("complaints_score"),
        F.coalesce("reviews_customer_score", neutral).alias("reviews_customer_score"),
        F.coalesce("reviews_employee_score", neutral).alias("reviews_employee_score"),
        F.lit(weights.social).alias("w_social"),
        F.lit(weights.search).alias("w_search"),
        F.lit(weights.complaints).alias("w_complaints"),
        F.lit(weights.reviews_customer).alias("w_reviews_customer"),
        F.lit(weights.reviews_employee).alias("w_reviews_employee"),
        (F.col("twitter_posts") + F.col("reddit_messages")).alias("social_volume"),
        "trends_rsv_avg", "cfpb_complaints", "min_sample_size_met", "anomaly_flag", "data_freshness_ok",
    )
    raw = parts.withColumn(
        "score_raw",
        # Rounded so that rows whose components are equal tie exactly.
        F.round(
            F.col("w_social") * F.col("social_score")
            + F.col("w_search") * F.col("search_score")
            + F.col("w_complaints") * F.col("complaints_score")
            + F.col("w_reviews_customer") * F.col("reviews_customer_score")
            + F.col("w_reviews_employee") * F.col("reviews_employee_score"),
            9,
        ),
    )
    return label_scores(rank_and_lag(raw, cfg, calendar_lag), cfg)


def rank_and_lag(df: DataFrame, cfg: ScoreSettings, calendar_lag: bool = False) -> DataFrame:
    """Rank among peers and the score some rows (or calendar days) earlier."""
    peers = Window.partitionBy("date", "country")
    series = Window.partitionBy("brand_id", "country")
    if calendar_lag:
        day = F.datediff("date", F.lit("1970-01-01"))

        def back(n: int) -> Column:
            return F.first("score_raw").over(series.orderBy(day).rangeBetween(-n, -n))
    else:

        def back(n: int) -> Column:
            return F.lag("score_raw", n).over(series.orderBy("date"))

    return df.withColumns(
        {
            "composite_score": clamp(F.col("score_raw"), 0.0, 100.0),
            "composite_rank": F.rank().over(peers.orderBy(F.col("score_raw").desc())),
            "composite_percentile": F.percent_rank().over(peers.orderBy("score_raw")) * 100,
            "_short": back(cfg.short_lag),
            "_long": back(cfg.long_lag),
        }
    )


def label_scores(df: DataFrame, cfg: ScoreSettings = DEFAULT_SCORE) -> DataFrame:
    """Changes, risk category, direction and the note for reviewers."""
    score, moved = F.col("composite_score"), F.col("change_7d")
    risk = F.lit(cfg.risk_default)
    for cut, name in reversed(cfg.risk_cuts):
        risk = F.when(score < cut, F.lit(name)).otherwise(risk)
    direction = (
        F.when(moved < -cfg.direction_cut, "Declining")
        .when(moved > cfg.direction_cut, "Improving")
        .otherwise("Stable")
    )
    note = (
        F.when(F.col("anomaly_flag"), "Anomaly detected - manual review recommended")
        .when(~F.col("min_sample_size_met"), "Insufficient data - interpret with caution")
        .when(score < cfg.critical_score, "Critical score - immediate attention required")
        .when(F.abs(moved) > cfg.notable_change, "Significant change detected")
    )
    return (
        df.withColumns(
            {
                "change_7d": change_pct(score, F.col("_short")),
                "change_28d": change_pct(score, F.col("_long")),
            }
        )
        .withColumns(
            {
                "risk_category": risk,
                "trend_direction": direction,
                "notes": note,
                "calc_version": F.lit(cfg.calc_version),
            }
        )
        .drop("score_raw", "_short", "_long")
    )


def four_part_score(
    metrics: DataFrame,
    weights: FourPartWeights = FourPartWeights(),
    cfg: ScoreSettings = DEFAULT_SCORE,
    reviews: DataFrame | None = None,
) -> DataFrame:
    """Alternative score: social blends tone and volume, reviews are one term."""
    base = metrics
    if reviews is not None:
        base = base.join(
            reviews.select(*KEYS, "reviews_customer_score", "reviews_employee_score"), list(KEYS), "left"
        )
    else:
        empty = F.lit(None).cast("double")
        base = base.withColumns({"reviews_customer_score": empty, "reviews_employee_score": empty})

    def filled(name: str) -> Column:
        return F.coalesce(name, F.lit(cfg.neutral))

    tone_part, customer = weights.sentiment_part, weights.customer_part
    parts = base.select(
        "brand_id", "brand_name", "date", "country",
        (
            filled("social_sentiment_index") * tone_part + filled("social_volume_index") * (1 - tone_part)
        ).alias("social"),
        filled("trends_visibility_index").alias("search"),
        filled("cfpb_complaints_index").alias("complaints"),
        (
            filled("reviews_customer_score") * customer
            + filled("reviews_employee_score") * (1 - customer)
        ).alias("reviews"),
    )
    total = (
        F.col("social") * weights.social
        + F.col("search") * weights.search
        + F.col("complaints") * weights.complaints
        + F.col("reviews") * weights.reviews
    )
    return parts.withColumns(
        {
            "composite_score": clamp(total, 0.0, 100.0),
            "w_social": F.lit(weights.social),
            "w_search": F.lit(weights.search),
            "w_complaints": F.lit(weights.complaints),
            "w_reviews": F.lit(weights.reviews),
            "calc_version": F.lit(cfg.calc_version),
        }
    )


# Rating columns of a review, all on a 1-5 scale.
RATINGS = (
    "overall_rating", "work_life_balance", "comp_benefits", "culture_values",
    "career_opportunities", "senior_management",
)


def employee_review_index(reviews: DataFrame, day: str = "date") -> DataFrame:
    """Mean rating per brand, day and country rescaled from 1-5 to 0-100."""
    rolled = reviews.groupBy("brand_id", day, "country").agg(
        F.count(F.lit(1)).alias("review_count"), F.avg("overall_rating").alias("rating_avg"),
        F.avg("ceo_approval").alias("ceo_approval"),
        F.avg("recommend_to_friend").alias("recommend_to_friend"),
        *[F.avg(r).alias(r) for r in RATINGS[1:]],
    )
    listed = F.array("rating_avg", *RATINGS[1:])
    rated = F.filter(listed, lambda x: x.isNotNull())
    mean = F.try_divide(
        F.aggregate(rated, F.lit(0.0), lambda a, x: a + x), F.size(rated).cast("double")
    )
    return rolled.withColumn("employee_review_index", clamp((mean - 1) / 4 * 100, 0.0, 100.0))


def forecast(scores: DataFrame, horizon: int = 14, value: str = "composite_score") -> DataFrame:
    """Linear projection per brand and country for the next ``horizon`` days."""
    day = F.datediff("date", F.lit("1970-01-01")).cast("double")
    fit = scores.groupBy("brand_id", "country").agg(
        F.regr_slope(F.col(value), day).alias("slope"),
        F.regr_intercept(F.col(value), day).alias("intercept"),
        F.max("date").alias("last_date"),
    )
    ahead = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    return (
        fit.filter(F.col("slope").isNotNull())
        .select("brand_id", "country", "slope", "intercept", "last_date", ahead.alias("days_ahead"))
        .withColumn("date", F.date_add("last_date", F.col("days_ahead")))
        .withColumn(
            "predicted",
            clamp(
                F.col("intercept") + F.col("slope") * F.datediff("date", F.lit("1970-01-01")), 0.0, 100.0
            ),
        )
        .select("brand_id", "country", "date", "days_ahead", "predicted")
    )
