"""Raw layer: typing, quality filters and derived columns of each feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pulsemart.functions.parsing import iso_timestamp, json_text, json_whole, short_us_date
from pulsemart.functions.text import contains_any, label_by_terms
from pulsemart.settings import COMPLAINT_TERMS, SEVERITY_DEFAULT, SEVERITY_TERMS, DateRange


def within(df: DataFrame, days: DateRange | None, column: str = "date") -> DataFrame:
    """Optional inclusive date range.

    A feed read from day folders also has ``dt``; the folders in range, with a
    day to spare on either side, are all that is read then.
    """
    if days and "dt" in df.columns and column != "dt":
        if days.start:
            df = df.filter(F.col("dt") >= F.date_sub(F.lit(days.start).cast("date"), 1))
        if days.end:
            df = df.filter(F.col("dt") <= F.date_add(F.lit(days.end).cast("date"), 1))
    if days and days.start:
        df = df.filter(F.col(column) >= F.lit(days.start).cast("date"))
    if days and days.end:
        df = df.filter(F.col(column) <= F.lit(days.end).cast("date"))
    return df


def _event_time(df: DataFrame) -> DataFrame:
    ts = iso_timestamp(F.col("ts_event"))
    return df.withColumns(
        {"ts_event": ts, "date": ts.cast("date"), "collected_at": iso_timestamp(F.col("collected_at"))}
    )


def _filled(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")


def twitter_posts(feed: DataFrame, days: DateRange | None = None) -> DataFrame:
    """Posts with engagement total (null when any counter is) and text length."""
    kept = feed.filter(F.col("tweet_id").isNotNull() & F.col("brand_id").isNotNull() & _filled("text"))
    total = F.col("like_count") + F.col("reply_count") + F.col("retweet_count") + F.col("quote_count")
    return within(_event_time(kept), days).withColumns(
        {"total_engagements": total, "text_length": F.length("text")}
    )


def reddit_messages(feed: DataFrame, days: DateRange | None = None) -> DataFrame:
    """Posts and comments; messages of deleted or unknown authors are dropped."""
    kept = feed.filter(
        F.col("reddit_id").isNotNull()
        & F.col("brand_id").isNotNull()
        & F.coalesce("body", "title").isNotNull()
        & (F.col("author") != "[deleted]")
    )
    text = F.coalesce("body", "title", F.lit(""))
    return within(_event_time(kept), days).withColumns(
        {"text_length": F.length(text), "combined_text": text}
    )


def trends_timeseries(feed: DataFrame, days: DateRange | None = None) -> DataFrame:
    """Search-interest points with a usable, non-negative value."""
    kept = feed.filter(
        F.col("brand_id").isNotNull() & F.col("keyword").isNotNull() & (F.col("value") >= 0)
    )
    return within(_event_time(kept), days)


def complaints(feed: DataFrame, days: DateRange | None = None) -> DataFrame:
    """Regulator complaints as the score chain reads them."""
    kept = feed.filter(F.col("complaint_id").isNotNull() & F.col("brand_id").isNotNull())
    narrative = F.col("consumer_complaint_narrative")
    return within(_event_time(kept), days).withColumns(
        {
            "date_sent_to_company": iso_timestamp(F.col("date_sent_to_company")),
            "narrative_length": F.coalesce(F.length(narrative), F.lit(0)),
            "has_narrative": F.coalesce(narrative != "", F.lit(False)),
        }
    )


def complaints_export(
    feed: DataFrame,
    brand_id: str | Column = "td_bank",
    min_chars: int = 20,
    severity_terms=SEVERITY_TERMS,
) -> DataFrame:
    """Regulator export as the clustering chain reads it: only real narratives."""
    text = F.col("Consumer_complaint_narrative")
    brand = F.lit(brand_id) if isinstance(brand_id, str) else brand_id
    kept = feed.filter(text.isNotNull() & (F.length(text) > min_chars)).withColumn("_low", F.lower(text))
    return kept.select(
        F.col("Complaint_ID").alias("complaint_id"),
        brand.alias("brand_id"),
        text.alias("complaint_text"),
        F.col("Product").alias("product"),
        F.col("Sub_product").alias("sub_product"),
        F.col("Issue").alias("issue"),
        F.col("Sub_issue").alias("sub_issue"),
        F.col("Company").alias("company"),
        F.col("State").alias("state"),
        F.col("ZIP_code").alias("zip_code"),
        F.col("Company_response_to_consumer").alias("company_response"),
        F.col("Timely_response").alias("timely_response"),
        F.col("Consumer_disputed").alias("consumer_disputed"),
        F.col("Submitted_via").alias("submitted_via"),
        short_us_date(F.col("Date_received")).alias("complaint_date"),
        short_us_date(F.col("Date_sent_to_company")).alias("date_sent_to_company"),
        F.length(text).alias("text_length"),
        (F.length(text) > min_chars).alias("has_meaningful_text"),
        label_by_terms(F.col("_low"), severity_terms, SEVERITY_DEFAULT).alias("severity_level"),
        F.lit(True).alias("is_complaint"),
    )


def reddit_events(
    feed: DataFrame,
    brand_id: str | None = "td_bank",
    min_chars: int = 10,
    complaint_terms=COMPLAINT_TERMS,
) -> DataFrame:
    """Enriched social events with metadata fields and a complaint flag."""
    kept = feed.filter(F.col("text").isNotNull() & (F.length("text") > min_chars))
    if brand_id is not None:
        kept = kept.filter(F.col("brand_id") == brand_id)
    kept = kept.withColumn("_low", F.lower("text"))
    meta = F.col("metadata")
    negative = F.coalesce(F.col("sentiment") < 0, F.lit(False))
    return kept.select(
        "event_id", "brand_id", "source", "text", "sentiment", "severity", "topics", "ts_event",
        F.to_date("ts_event").alias("event_date"),
        "nlp_confidence", "nlp_model", "nlp_processed_at", "language", "geo_country",
        *[json_text(meta, name).alias(name) for name in ("subreddit", "author", "reddit_type", "title")],
        *[json_whole(meta, name).alias(name) for name in ("score", "num_comments")],
        F.length("text").alias("text_length"),
        (F.length("text") > min_chars).alias("has_meaningful_text"),
        (contains_any(F.col("_low"), complaint_terms) | negative).alias("is_complaint"),
    )
