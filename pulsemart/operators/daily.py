"""Daily rollups per brand and country, one per feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsemart.functions.scores import change_pct, peer_percentile, ratio, share, tally, tone_index, yes
from pulsemart.functions.text import label_by_terms, tone, toxicity
from pulsemart.settings import (
    DEFAULT_DAILY, PRODUCT_DEFAULT, PRODUCT_TERMS, REDDIT_TONE, TWITTER_TONE,
    DailySettings, ToneLexicon,
)

KEYS = ("brand_id", "date", "country")
PEERS = ("date", "country")


def _tone_metrics(cfg: DailySettings) -> list[Column]:
    s, t = F.col("sentiment_score"), F.col("toxicity_score")
    return [
        F.avg(s).alias("sentiment_avg"),
        F.stddev_samp(s).alias("sentiment_stddev"),
        F.avg(t).alias("toxicity_avg"),
        share(t > cfg.toxic_cut).alias("toxicity_rate"),
        F.avg("text_length").alias("avg_text_length"),
    ]


def _tone_anomaly(cfg: DailySettings) -> Column:
    spread = F.coalesce("sentiment_stddev", F.lit(cfg.tone_anomaly_spread))
    return yes(F.abs("sentiment_avg") > spread * cfg.tone_anomaly_factor)


def twitter_daily(
    posts: DataFrame, lexicon: ToneLexicon = TWITTER_TONE, cfg: DailySettings = DEFAULT_DAILY
) -> DataFrame:
    """Posts, authors, engagement, tone and toxicity per brand, day and country."""
    lowered = F.col("_low")
    scored = posts.withColumn("_low", F.lower("text")).select(
        "brand_id", "date",
        F.coalesce("geo_country", F.lit("Unknown")).alias("country"),
        "author_id", "total_engagements", "text_length", "possibly_sensitive",
        tone(lowered, lexicon).alias("sentiment_score"),
        toxicity(lowered, lexicon).alias("toxicity_score"),
    )
    s = F.col("sentiment_score")
    rolled = scored.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("posts"),
        F.count_distinct("author_id").alias("authors"),
        F.sum("total_engagements").alias("engagements"),
        share(s > cfg.tone_cut).alias("positive_rate"),
        share(s < -cfg.tone_cut).alias("negative_rate"),
        F.avg("total_engagements").alias("avg_engagements_per_post"),
        share(F.col("total_engagements") > cfg.high_engagement).alias("high_engagement_rate"),
        share(F.col("possibly_sensitive")).alias("sensitive_content_rate"),
        *_tone_metrics(cfg),
    )
    return rolled.select(
        *KEYS, "posts", "authors", "engagements", "sentiment_avg", "sentiment_stddev",
        "positive_rate", "negative_rate", "toxicity_avg", "toxicity_rate",
        "avg_engagements_per_post", "high_engagement_rate", "avg_text_length",
        "sensitive_content_rate",
        peer_percentile("posts", *PEERS).alias("volume_index"),
        tone_index(F.col("sentiment_avg")).alias("sentiment_index"),
        (F.col("posts") >= cfg.twitter_min_posts).alias("min_sample_size_met"),
        _tone_anomaly(cfg).alias("anomaly_flag"),
        F.lit(True).alias("data_freshness_ok"),
    )


def reddit_daily(
    messages: DataFrame, lexicon: ToneLexicon = REDDIT_TONE, cfg: DailySettings = DEFAULT_DAILY
) -> DataFrame:
    """Messages, authors, votes, tone and toxicity per brand, day and country."""
    lowered = F.col("_low")
    scored = messages.withColumn("_low", F.lower("combined_text")).select(
        "brand_id", "date",
        F.coalesce("geo_country", F.lit("Unknown")).alias("country"),
        "author", "subreddit", "type", "score", "upvote_ratio", "text_length",
        tone(lowered, lexicon).alias("sentiment_score"),
        toxicity(lowered, lexicon).alias("toxicity_score"),
    )
    s = F.col("sentiment_score")
    rolled = scored.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_distinct("author").alias("unique_authors"),
        F.count_distinct("subreddit").alias("subreddits"),
        tally(F.col("type") == "post").alias("posts"),
        tally(F.col("type") == "comment").alias("comments"),
        F.sum("score").alias("score_sum"),
        F.avg("score").alias("score_avg"),
        share(F.col("score") > 0).alias("positive_score_rate"),
        share(F.col("score") < 0).alias("negative_score_rate"),
        share(s > cfg.tone_cut).alias("positive_sentiment_rate"),
        share(s < -cfg.tone_cut).alias("negative_sentiment_rate"),
        ratio(
            tally(F.col("upvote_ratio") > cfg.high_upvote), F.count("upvote_ratio")
        ).alias("high_upvote_ratio_rate"),
        *_tone_metrics(cfg),
    )
    return rolled.select(
        *KEYS, "messages", "unique_authors", "subreddits", "posts", "comments", "score_sum",
        "score_avg", "positive_score_rate", "negative_score_rate", "sentiment_avg",
        "sentiment_stddev", "positive_sentiment_rate", "negative_sentiment_rate",
        "toxicity_avg", "toxicity_rate", "avg_text_length", "high_upvote_ratio_rate",
        peer_percentile("messages", *PEERS).alias("volume_index"),
        tone_index(F.col("sentiment_avg")).alias("sentiment_index"),
        (F.col("messages") >= cfg.reddit_min_messages).alias("min_sample_size_met"),
        _tone_anomaly(cfg).alias("anomaly_flag"),
        F.lit(True).alias("data_freshness_ok"),
    )


def country_of_geo(geo: Column) -> Column:
    """US regions count as US; other areas stand for themselves."""
    return F.when(geo.startswith("US-"), F.lit("US")).otherwise(geo)


def trends_daily(
    points: DataFrame,
    cfg: DailySettings = DEFAULT_DAILY,
    calendar_lag: bool = False,
    top_keywords: bool = True,
) -> DataFrame:
    """Search interest per brand, day, country and region with changes and rank.

    Changes compare with the 7th and 28th earlier *row* of the series; with
    ``calendar_lag`` they compare with the calendar day instead.  The ranked
    keywords share the one shuffle of the points, but need all points in it;
    callers that do not read them switch them off, and points are summed up
    before they are shuffled.
    """
    keys = (*KEYS, "region")
    base = points.select(
        "brand_id", "date",
        country_of_geo(F.col("geo")).alias("country"),
        F.col("geo").alias("region"),
        "keyword", "value", "is_brand_keyword",
    )
    brand, value = F.col("is_brand_keyword"), F.col("value")
    ranked = []
    if top_keywords:
        best = Window.partitionBy(*keys).orderBy(F.col("value").desc(), "keyword")
        base = base.withColumn("place", F.row_number().over(best))
        # The place filter keeps the list at its fixed size.
        strongest = F.collect_list(F.when(F.col("place") <= cfg.top_keywords, F.struct("place", "keyword", "value")))
        ranked = [
            F.transform(
                F.array_sort(strongest),
                lambda k: F.struct(k["keyword"].alias("keyword"), k["value"].alias("value")),
            ).alias("top_keywords")
        ]
    rolled = base.groupBy(*keys).agg(
        F.avg(F.when(brand, value)).alias("brand_rsv_avg"),
        F.avg(F.when(~brand, value)).alias("category_rsv_avg"),
        F.avg(value).alias("rsv_avg"),
        F.max(value).alias("rsv_max"),
        F.min(value).alias("rsv_min"),
        F.stddev_samp(value).alias("rsv_stddev"),
        F.count(F.lit(1)).alias("data_points"),
        F.count_distinct("keyword").alias("unique_keywords"),
        *ranked,
    )

    series = Window.partitionBy("brand_id", "country", "region").orderBy("date")
    if calendar_lag:
        day = F.datediff("date", F.lit("1970-01-01"))
        series = Window.partitionBy("brand_id", "country", "region").orderBy(day)
        back = lambda n: F.first("rsv_avg").over(series.rangeBetween(-n, -n))
    else:
        back = lambda n: F.lag("rsv_avg", n).over(series)
    now = F.col("rsv_avg")
    moved = rolled.withColumns({"_back7": back(7), "_back28": back(28)}).withColumns(
        {
            "rsv_trend_7d": change_pct(now, F.col("_back7")),
            "rsv_trend_28d": change_pct(now, F.col("_back28")),
        }
    )
    unusual = (now > cfg.trends_anomaly_mean) | (F.col("rsv_trend_7d") > cfg.trends_anomaly_change)
    return moved.select(
        *keys, "rsv_avg", "rsv_max", "rsv_min", "rsv_stddev", "brand_rsv_avg", "category_rsv_avg",
        (F.col("brand_rsv_avg") - F.col("category_rsv_avg")).alias("brand_category_diff"),
        "rsv_trend_7d", "rsv_trend_28d",
        peer_percentile("rsv_avg", *PEERS).alias("visibility_index"),
        "data_points", "unique_keywords",
        *(["top_keywords"] if top_keywords else []),
        # The region is part of the grain, so a row covers one region at most.
        F.col("region").isNotNull().cast("bigint").alias("regions_covered"),
        (F.col("data_points") >= cfg.trends_min_points).alias("min_sample_size_met"),
        yes(unusual).alias("anomaly_flag"),
        F.lit(True).alias("data_freshness_ok"),
    )


def heightened_severity(score: Column, disputed: Column, timely: Column) -> Column:
    """Severity plus .2 for disputed and late answers, .1 for either."""
    return (
        F.when(disputed & ~timely, score + 0.2)
        .when(disputed, score + 0.1)
        .when(~timely, score + 0.1)
        .otherwise(score)
    )


def _kinds(column: str) -> Column:
    """Number of different values; states, categories and zip codes are closed lists, so the set stays small."""
    return F.size(F.collect_set(column)).cast("bigint")


def complaints_daily(rows: DataFrame, cfg: DailySettings = DEFAULT_DAILY) -> DataFrame:
    """Complaint volume, answers, severity, products and places per day."""
    base = rows.withColumn("_low", F.lower("product")).select(
        "brand_id", "date", F.col("geo_country").alias("country"),
        "complaint_id", "state", "zip_code", "timely_response", "consumer_disputed",
        "has_narrative", "narrative_length", "company_public_response", "severity_score",
        heightened_severity(
            F.col("severity_score"), F.col("consumer_disputed"), F.col("timely_response")
        ).alias("enhanced"),
        label_by_terms(F.col("_low"), PRODUCT_TERMS, PRODUCT_DEFAULT).alias("category"),
    )
    rolled = base.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("complaints"),
        F.count_distinct("complaint_id").alias("unique_complaints"),
        share(F.col("timely_response")).alias("timely_rate"),
        share(F.col("consumer_disputed")).alias("dispute_rate"),
        share(F.col("has_narrative")).alias("narrative_rate"),
        share(F.col("company_public_response").isNotNull()).alias("public_response_rate"),
        F.avg("severity_score").alias("severity_avg"),
        F.avg("enhanced").alias("enhanced_severity_avg"),
        F.max("severity_score").alias("severity_max"),
        F.stddev_samp("severity_score").alias("severity_stddev"),
        F.avg("narrative_length").alias("avg_narrative_length"),
        share(F.col("narrative_length") > cfg.long_narrative).alias("long_narrative_rate"),
        _kinds("state").alias("states_affected"),
        _kinds("category").alias("product_categories"),
        _kinds("zip_code").alias("zip_codes_affected"),
        # On equal counts the smallest value is the commonest.
        F.mode("category", True).alias("top_product_category"),
        F.mode("state", True).alias("top_state"),
    )
    # Ranked on a rounded mean: equal means tie in whatever order rows were summed.
    indexed = rolled.withColumn("_severity", F.round("enhanced_severity_avg", 9)).withColumns(
        {
            "complaints_volume_index": 100 - peer_percentile("complaints", *PEERS),
            "complaints_severity_index": 100 - peer_percentile("_severity", *PEERS),
            "response_quality_index": (
                F.col("timely_rate") * 0.6 + (1 - F.col("dispute_rate")) * 0.4
            ) * 100,
        }
    )
    combined = (
        F.col("complaints_volume_index") * 0.4
        + F.col("complaints_severity_index") * 0.4
        + F.col("response_quality_index") * 0.2
    )
    unusual = (F.col("complaints") > cfg.complaints_anomaly_count) | (
        F.col("enhanced_severity_avg") > cfg.complaints_anomaly_severity
    )
    return indexed.withColumns(
        {
            "complaints_index": combined,
            "min_sample_size_met": F.col("complaints") >= cfg.complaints_min,
            "anomaly_flag": yes(unusual),
            "data_freshness_ok": F.lit(True),
        }
    ).drop("_severity")
