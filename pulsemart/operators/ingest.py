"""Normalisation of source records into the common shapes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsemart.functions.automaton import automaton
from pulsemart.functions.ids import complaint_event_id, fingerprint, social_event_id
from pulsemart.functions.parsing import approval_share, first_filled, first_parsed, iso_timestamp, number
from pulsemart.functions.text import strip
from pulsemart.settings import TREND_CATEGORIES, TREND_COMBINATIONS

DELETED = "[deleted]"
PERMALINK_ROOT = "https://reddit.com"


def normalise_posts(posts: DataFrame, run_ts: Column, run_id: str) -> DataFrame:
    """Posts (id, title, selftext, author, created_at, …) as events."""
    text = strip(F.concat_ws("\n\n", F.coalesce("title", F.lit("")), F.coalesce("selftext", F.lit(""))))
    meta = _social_metadata("post", F.col("title"), F.col("num_comments"), F.col("upvote_ratio"), F.col("url"),
                            F.lit(None).cast("string"))
    return _event(posts, "post", text, meta, run_ts, run_id)


def normalise_comments(comments: DataFrame, run_ts: Column, run_id: str) -> DataFrame:
    """Comments (id, body, author, created_at, parent_id, …) as events."""
    none = F.lit(None).cast("string")
    meta = _social_metadata("comment", none, none.cast("bigint"), none.cast("double"), none, F.col("parent_id"))
    return _event(comments, "comment", strip(F.col("body")), meta, run_ts, run_id)


def _social_metadata(kind, title, num_comments, upvote_ratio, url, parent) -> Column:
    return F.to_json(
        F.struct(
            F.col("id").cast("string").alias("reddit_id"),
            F.lit(kind).alias("reddit_type"),
            F.col("subreddit"),
            first_filled(F.col("author"), F.lit(DELETED)).alias("author"),
            title.alias("title"),
            F.col("score"),
            num_comments.alias("num_comments"),
            upvote_ratio.alias("upvote_ratio"),
            url.alias("url"),
            F.concat(F.lit(PERMALINK_ROOT), F.col("permalink")).alias("permalink"),
            parent.alias("parent_id"),
            F.coalesce("edited", F.lit(False)).alias("edited"),
        )
    )


def _event(rows: DataFrame, kind: str, text: Column, meta: Column, run_ts: Column, run_id: str) -> DataFrame:
    return rows.select(
        social_event_id(F.lit(kind), F.col("id")).alias("event_id"),
        F.col("created_at").alias("ts_event"),
        "brand_id",
        F.lit("reddit").alias("source"),
        F.lit(None).cast("string").alias("geo_country"),
        text.alias("text"),
        fingerprint(text).alias("content_hash"),
        meta.alias("metadata"),
        run_ts.alias("_ingested_at"),
        F.lit(run_id).alias("_source_run"),
    )


def first_comments(comments: DataFrame, thread: str, position: str, limit: int = 10) -> DataFrame:
    """The first comments of every thread."""
    w = Window.partitionBy(thread).orderBy(position)
    return comments.withColumn("_place", F.row_number().over(w)).filter(F.col("_place") <= limit).drop("_place")


def company_brand(company: Column, names: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """Brand of a company name.

    An exact match (ignoring case) of any brand comes first, then containment
    in either direction; within each, the first brand of the dictionary wins.
    """
    brands = [brand for brand, _ in names]
    listed = [(name.upper(), k) for k, (_, own) in enumerate(names) for name in own]

    @F.arrow_udf("string")
    def found(upper: pa.Array) -> pa.Array:
        coded = upper.dictionary_encode()
        chosen = pa.array(_company_brands(coded.dictionary.to_pylist(), listed, brands), pa.string())
        return chosen.take(coded.indices)

    return F.when(F.nullif(company, F.lit("")).isNotNull(), found(F.upper(company)))


def _company_brands(companies: list[str], listed: list[tuple[str, int]], brands: list[str]) -> list[str | None]:
    """Brands of distinct upper-case companies."""
    exact: dict[str, int] = {}
    for name, brand in listed:
        exact.setdefault(name, brand)
    patterns = tuple(n for n in exact if n)
    everything = {brand for name, brand in listed if not name}  # an empty name is in every company
    best = [min(everything, default=len(brands))] * len(companies)
    for first, _, hits in automaton(patterns).search(companies):
        owner = np.array([exact[p] for p in patterns], np.int64)[hits.pattern]
        for row, brand in zip(hits.text.tolist(), owner.tolist(), strict=True):
            best[first + row] = min(best[first + row], brand)
    # names that contain the company: the first in the dictionary's order
    row_of = "\0".join([""] + [n for n, _ in listed] + [""])
    starts = np.cumsum([1] + [len(n) + 1 for n, _ in listed])
    out: list[str | None] = []
    for company, around in zip(companies, best, strict=True):
        at = row_of.find(company) if company and "\0" not in company else -1
        if at >= 0:
            around = min(around, listed[int(np.searchsorted(starts, at, "right")) - 1][1])
        number = exact.get(company, around)
        out.append(brands[number] if number < len(brands) else None)
    return out


def complaint_text(company: Column, issue: Column, sub_issue: Column, narrative: Column, product: Column) -> Column:
    """Labelled parts joined by `` | ``, skipping blanks; else a fallback sentence."""

    def part(label: str, value: Column) -> Column:
        return F.when(value != "", F.concat(F.lit(f"{label}: "), value))

    parts = F.concat_ws(
        " | ", part("Issue", issue), part("Sub-issue", sub_issue), part("Complaint", narrative),
        part("Product", product),
    )
    fallback = F.concat(F.lit("CFPB complaint for "), F.coalesce(company, F.lit("Unknown")))
    return F.when(parts != "", parts).otherwise(fallback)


def day_or_run_time(day: Column, run_ts: Column) -> Column:
    """``yyyy-MM-dd`` text as a timestamp, else the run time."""
    return F.coalesce(F.try_to_timestamp(day, F.lit("yyyy-MM-dd")), run_ts)


def normalise_complaints(
    rows: DataFrame, names: Sequence[tuple[str, Sequence[str]]], run_ts: Column, run_id: str
) -> DataFrame:
    """Regulator records of known companies as events."""
    member = (
        "complaint_id", "company", "product", "issue", "sub_issue", "state", "zip_code", "submitted_via",
        "company_response", "timely_response", "consumer_disputed", "consumer_consent_provided",
    )
    meta = F.to_json(F.struct(*[F.col(m) for m in member if m in rows.columns]))
    return (
        rows.withColumn("brand_id", company_brand(F.col("company"), names))
        .filter(F.col("brand_id").isNotNull())
        .select(
            complaint_event_id(F.col("complaint_id")).alias("event_id"),
            day_or_run_time(F.col("date_received"), run_ts).alias("ts_event"),
            "brand_id",
            F.lit("cfpb").alias("source"),
            F.lit("US").alias("geo_country"),
            complaint_text(
                F.col("company"), F.col("issue"), F.col("sub_issue"),
                F.col("consumer_complaint_narrative"), F.col("product"),
            ).alias("text"),
            fingerprint(F.coalesce(F.col("complaint_id").cast("string"), F.lit(""))).alias("content_hash"),
            meta.alias("metadata"),
            run_ts.alias("_ingested_at"),
            F.lit(run_id).alias("_source_run"),
        )
    )


def flatten_tweets(tweets: DataFrame, users: DataFrame, places: DataFrame, collected_at: Column) -> DataFrame:
    """Tweets with author and place looked up by id."""
    author = users.select(
        F.col("id").alias("author_id"), F.col("username").alias("author_username"),
        F.col("verified").alias("_verified"), F.col("location").alias("author_location"),
    )
    place = places.select(F.col("id").alias("geo_place_id"), F.col("country").alias("geo_country"))
    return (
        tweets.join(author, "author_id", "left")
        .join(place, "geo_place_id", "left")
        .select(
            "brand_id",
            F.col("id").cast("string").alias("tweet_id"),
            F.col("created_at").alias("ts_event"),
            "author_id", "author_username",
            F.coalesce("_verified", F.lit(False)).alias("author_verified"),
            "author_location", "text",
            F.coalesce("lang", F.lit("en")).alias("lang"),
            "like_count", "reply_count", "retweet_count", "quote_count",
            F.coalesce("possibly_sensitive", F.lit(False)).alias("possibly_sensitive"),
            "geo_country", "geo_place_id",
            collected_at.alias("collected_at"),
        )
    )


def expand_trend_terms(
    brands: DataFrame,
    categories: Sequence[str] = TREND_CATEGORIES,
    combinations: Sequence[str] = TREND_COMBINATIONS,
) -> DataFrame:
    """Search terms per brand (brand_id, brand_terms): own, category and combined.

    Each brand row explodes a list whose length is fixed by the parameters.
    """
    first = F.get("brand_terms", 0)

    def typed(keyword: Column, kind: str) -> Column:
        return F.struct(keyword.alias("keyword"), F.lit(kind).alias("keyword_type"))

    own = F.transform("brand_terms", lambda t: typed(t, "brand"))
    fixed = F.array(
        *[typed(F.lit(c), "category") for c in categories],
        *[typed(F.concat(first, F.lit(f" {c}")), "brand_category") for c in combinations],
        *[typed(F.concat(F.lit(f"{c} "), first), "category_brand") for c in combinations],
    )
    return brands.select("brand_id", F.explode(F.concat(own, fixed)).alias("t")).select(
        "brand_id", "t.keyword", "t.keyword_type",
        (F.col("t.keyword_type") != "category").alias("is_brand_keyword"),
    )


def attach_related(points: DataFrame, related: DataFrame, keys: Sequence[str], limit: int = 5) -> DataFrame:
    """Add the first related queries of each keyword to its points."""
    w = Window.partitionBy(*keys).orderBy("position")
    lists = (
        related.withColumn("_place", F.row_number().over(w))
        .filter(F.col("_place") <= limit)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("_place", "query"))).alias("_ranked"))
        .select(*keys, F.transform("_ranked", lambda r: r["query"]).alias("related_queries_top"))
    )
    return points.join(lists, list(keys), "left")


def trending(searches: DataFrame, area: str = "geo", volume: str = "volume", limit: int = 20) -> DataFrame:
    """The top searches of every area with their rank."""
    w = Window.partitionBy(area).orderBy(F.col(volume).desc(), "query")
    return (
        searches.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= limit)
        .select(area, "query", "rank")
    )


# Names a review field may carry, first filled wins.
REVIEW_FIELDS = {
    "date": ("date", "review_date", "created_at"),
    "review_id": ("id", "review_id"),
    "overall_rating": ("rating", "overall_rating"),
    "work_life_balance": ("work_life_balance_rating",),
    "comp_benefits": ("compensation_benefits_rating", "compensation_and_benefits_rating"),
    "culture_values": ("culture_values_rating", "culture_and_values_rating"),
    "career_opportunities": ("career_opportunities_rating",),
    "senior_management": ("senior_management_rating",),
    "ceo_approval": ("ceo_approval", "approve_of_ceo"),
    "recommend_to_friend": ("recommend_to_friend", "recommend"),
    "employment_status": ("employment_status", "status", "employee_status"),
    "location": ("location", "employee_location"),
    "job_title": ("job_title", "position"),
    "employment_length": ("employment_length", "length_of_employment"),
    "review_title": ("title", "headline"),
    "pros": ("pros",),
    "cons": ("cons",),
    "advice_to_management": ("advice_to_management", "advice_to_mgmt"),
}
REVIEW_DATES = ("yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'", "MM/dd/yyyy")
REVIEW_NUMBERS = (
    "overall_rating", "work_life_balance", "comp_benefits", "culture_values",
    "career_opportunities", "senior_management",
)


def employment_bucket(status: Column) -> Column:
    lowered = F.lower(status)
    return (
        F.when(lowered.contains("current"), "current")
        .when(lowered.contains("former"), "former")
        .when(lowered.contains("intern"), "intern")
        .otherwise(status)
    )


def _review_fields(raw: DataFrame, document: str) -> DataFrame:
    names = sorted({n for options in REVIEW_FIELDS.values() for n in options})
    parsed = F.from_json(document, ", ".join(f"{n} string" for n in names))
    return raw.withColumn("_r", parsed).withColumns(
        {
            f"_{field}": first_filled(*[F.col(f"_r.{n}") for n in options])
            for field, options in REVIEW_FIELDS.items()
        }
    )


def normalise_reviews(raw: DataFrame, fetched_at: Column, document: str = "raw") -> DataFrame:
    """Dated reviews (brand_id, company_id, JSON text) in the review shape.

    An unparsable date is kept as it came.  Undated reviews are returned by
    :func:`undated_reviews`.
    """
    rows = _review_fields(raw, document).filter(F.col("_date").isNotNull())
    parsed = F.date_format(first_parsed(F.col("_date"), REVIEW_DATES), "yyyy-MM-dd'T'HH:mm:ss")

    def labelled(label: str, field: str) -> Column:
        return F.concat(F.lit(f"{label}: "), F.col(field))

    fallback_id = F.concat_ws("_", "company_id", F.xxhash64(document).cast("string"))
    return rows.select(
        "brand_id",
        F.coalesce("_review_id", fallback_id).alias("review_id"),
        F.coalesce(parsed, F.col("_date")).alias("ts_event"),
        *[number(F.col(f"_{n}")).alias(n) for n in REVIEW_NUMBERS],
        approval_share(F.col("_ceo_approval")).alias("ceo_approval"),
        approval_share(F.col("_recommend_to_friend")).alias("recommend_to_friend"),
        employment_bucket(F.col("_employment_status")).alias("employment_status"),
        *[F.col(f"_{n}").alias(n) for n in ("location", "job_title", "employment_length", "review_title",
                                            "pros", "cons", "advice_to_management")],
        F.concat_ws(
            " | ", labelled("Title", "_review_title"), labelled("Pros", "_pros"), labelled("Cons", "_cons"),
            labelled("Advice", "_advice_to_management"),
        ).alias("review_text"),
        "company_id",
        fetched_at.alias("fetched_at"),
        F.lit("glassdoor").alias("data_source"),
        F.lit("employee_review").alias("data_type"),
    )


def undated_reviews(raw: DataFrame, document: str = "raw") -> DataFrame:
    return _review_fields(raw, document).filter(F.col("_date").isNull()).select(*raw.columns)


def reviews_by_day(reviews: DataFrame, country: str = "US") -> DataFrame:
    """Review rows with the date and country the daily index groups by."""
    return reviews.withColumns(
        {"date": iso_timestamp(F.col("ts_event")).cast("date"), "country": F.lit(country)}
    )
