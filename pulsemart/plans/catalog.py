"""Registered queries: every operator applied to the whole test tables.

Doubles are rounded, and nested results are written out as text,
so that the rows can be compared with the SQL of the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsemart.functions.ids import fingerprint, social_event_id
from pulsemart.functions.parsing import approval_share
from pulsemart.functions.text import redact
from pulsemart.operators import (
    clusters, cursors, enrich, features, ingest, mentions, monitors, quality, raw, scoring,
    search, serving, versions,
)
from pulsemart.plans import brand_score, complaint_marts
from pulsemart.session import scratch_path, stage
from pulsemart.settings import DateRange, EnrichSettings
from pulsemart.sources import dimensions, landing, page_index, postings, rollups, samples, tables, vector_index
from pulsemart.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def tidy(df: DataFrame, digits: int = 9) -> DataFrame:
    """Doubles rounded, because a sum depends on the order of its rows."""
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in doubles})


def written(array: str | Column, line: Callable[[Column], Column]) -> Column:
    """An array of structs as one text."""
    return F.array_join(F.transform(array, line), "|")


def joined(*parts: Column) -> Column:
    return F.concat_ws(":", *[p.cast("string") for p in parts])


# ---------------------------------------------------------------- raw layer
@query
def raw_twitter_posts(spark, folder):
    posts = raw.twitter_posts(samples.twitter_feed(spark, folder))
    return tidy(posts.select("brand_id", "tweet_id", "ts_event", "date", "author_id", "total_engagements", "text_length", "geo_country"))


@query
def raw_reddit_messages(spark, folder):
    rows = raw.reddit_messages(samples.reddit_feed(spark, folder))
    return tidy(rows.select("brand_id", "reddit_id", "date", "author", "type", "score", "text_length", fingerprint(F.col("combined_text")).alias("text_hash")))


@query
def raw_trends_timeseries(spark, folder):
    rows = raw.trends_timeseries(samples.trends_feed(spark, folder))
    return rows.groupBy("brand_id", "keyword", "geo", "date", "is_brand_keyword").agg(F.count(F.lit(1)).alias("points"), F.sum("value").alias("total"))


@query
def raw_trends_date_range(spark, folder):
    rows = raw.trends_timeseries(samples.trends_feed(spark, folder), DateRange("2024-01-05", "2024-01-11"))
    return rows.groupBy("brand_id", "date").agg(F.count(F.lit(1)).alias("points"), F.max("value").alias("highest"))


@query
def raw_complaints(spark, folder):
    rows = raw.complaints(samples.complaints_feed(spark, folder))
    return tidy(rows.select("brand_id", "complaint_id", "date", "product", "timely_response", "consumer_disputed", F.to_date("date_sent_to_company").alias("sent"), "severity_score", "narrative_length", "has_narrative"))


@query
def raw_complaints_export(spark, folder):
    rows = raw.complaints_export(samples.complaints_export_feed(spark, folder), severity_terms=samples.SEVERITY_WORDS)
    return rows.select("complaint_id", "brand_id", "product", "issue", "state", "complaint_date", "date_sent_to_company", "text_length", "has_meaningful_text", "severity_level", "is_complaint")


@query
def raw_reddit_events(spark, folder):
    rows = _events(spark, folder)
    return tidy(rows.select("event_id", "brand_id", "event_date", "subreddit", "author", "reddit_type", "title", "score", "num_comments", "sentiment", "text_length", "has_meaningful_text", "is_complaint"))


# ------------------------------------------------------------ daily rollups
def _feeds(spark, folder) -> brand_score.ScoreFeeds:
    return brand_score.ScoreFeeds(
        samples.twitter_feed(spark, folder), samples.reddit_feed(spark, folder),
        samples.trends_feed(spark, folder), samples.complaints_feed(spark, folder),
        dimensions.brand_dictionary(spark),
    )


@query
def twitter_daily(spark, folder):
    return tidy(brand_score.twitter_table(samples.twitter_feed(spark, folder), tone=samples.TONE))


@query
def reddit_daily(spark, folder):
    return tidy(brand_score.reddit_table(samples.reddit_feed(spark, folder), tone=samples.TONE))


@query
def trends_daily(spark, folder):
    rows = brand_score.trends_table(samples.trends_feed(spark, folder))
    return tidy(rows.withColumn("top_keywords", written("top_keywords", lambda k: joined(k["keyword"], k["value"]))))


@query
def trends_daily_calendar(spark, folder):
    rows = brand_score.trends_table(samples.trends_feed(spark, folder), calendar_lag=True)
    return tidy(rows.select("brand_id", "date", "country", "region", "rsv_avg", "rsv_trend_7d", "rsv_trend_28d"))


@query
def complaints_daily(spark, folder):
    return tidy(brand_score.complaints_table(samples.complaints_feed(spark, folder)))


# ---------------------------------------------------------- composite score
def _metrics(spark, folder, literal_regions=False) -> DataFrame:
    return brand_score.brand_metrics(
        _feeds(spark, folder), literal_regions=literal_regions, twitter_tone=samples.TONE, reddit_tone=samples.TONE
    )


@query
def brand_daily_metrics(spark, folder):
    return tidy(_metrics(spark, folder))


@query
def brand_daily_metrics_by_region(spark, folder):
    return tidy(_metrics(spark, folder, literal_regions=True))


@query
def composite_score(spark, folder):
    return tidy(scoring.composite_score(_metrics(spark, folder)))


@query
def composite_score_calendar(spark, folder):
    """The same score; changes compare with the calendar day."""
    return tidy(scoring.composite_score(_metrics(spark, folder), calendar_lag=True))


def _review_scores(spark, folder) -> DataFrame:
    """Customer and employee scores per day from the review feed."""
    index = scoring.employee_review_index(ingest.reviews_by_day(_reviews(spark, folder)))
    return index.select(
        "brand_id", "date", "country", F.col("employee_review_index").alias("reviews_employee_score"),
        F.lit(None).cast("double").alias("reviews_customer_score"),
    )


@query
def latest_scores(spark, folder):
    return tidy(serving.latest_scores(scoring.composite_score(_metrics(spark, folder))))


@query
def four_part_score(spark, folder):
    rows = scoring.four_part_score(_metrics(spark, folder), reviews=_review_scores(spark, folder))
    return tidy(rows.select("brand_id", "date", "country", "social", "search", "complaints", "reviews", "composite_score"))


@query
def score_forecast(spark, folder):
    return tidy(scoring.forecast(scoring.composite_score(_metrics(spark, folder))), 5)


# --------------------------------------------------------------- clustering
def _events(spark, folder) -> DataFrame:
    return raw.reddit_events(samples.reddit_events_feed(spark, folder), complaint_terms=samples.COMPLAINT_WORDS)


def _exports(spark, folder) -> DataFrame:
    return raw.complaints_export(samples.complaints_export_feed(spark, folder), severity_terms=samples.SEVERITY_WORDS)


def _assigned(spark, folder) -> DataFrame:
    return complaint_marts.assigned_complaints(_events(spark, folder), _exports(spark, folder), samples.FEATURES)


@query
def unified_complaints(spark, folder):
    rows = features.unified_complaints(_events(spark, folder), _exports(spark, folder))
    return tidy(rows.withColumn("topics", F.array_join("topics", ",")).withColumn("complaint_text", fingerprint(F.col("complaint_text"))))


@query
def complaint_text_features(spark, folder):
    rows = features.text_features(features.unified_complaints(_events(spark, folder), _exports(spark, folder)), samples.FEATURES)
    return rows.select("complaint_id", fingerprint(F.col("cleaned_text")).alias("cleaned_hash"), "original_length", "word_count", "sentence_count", "feature_vector", "feature_score")


def _cluster_rows(spark, folder, literal_join: bool) -> DataFrame:
    shown = ("complaint_id", "source_type", "cluster_name", "cluster_description", "cluster_priority")
    rows = complaint_marts.complaint_clusters(_assigned(spark, folder), literal_join, columns=shown)
    return tidy(
        rows.select(
            *shown,
            "cluster_total_complaints", "cluster_days_active", "cluster_avg_severity", "cluster_reddit_count",
            "cluster_cfpb_count", "cluster_first_date", "cluster_last_date",
            F.array_join("cluster_common_sources", ",").alias("cluster_common_sources"),
        )
    )


@query
def complaint_clusters(spark, folder):
    return _cluster_rows(spark, folder, literal_join=False)


@query
def complaint_clusters_by_name(spark, folder):
    return _cluster_rows(spark, folder, literal_join=True)


@query
def cluster_summary(spark, folder):
    rows = clusters.cluster_summary(_assigned(spark, folder))
    return tidy(rows.withColumn("common_sources", F.array_join("common_sources", ",")))


def _stats(spark, folder) -> DataFrame:
    return complaint_marts.daily_stats(_assigned(spark, folder))


def _sample_text(array="sample_complaints") -> Column:
    return written(array, lambda s: joined(s["complaint_id"], s["source_type"], s["severity_level"], s["source_detail"], fingerprint(s["complaint_preview"])))


@query
def daily_cluster_stats(spark, folder):
    return tidy(_stats(spark, folder).withColumn("sample_complaints", _sample_text()))


@query
def daily_severity(spark, folder):
    return tidy(clusters.daily_severity(_stats(spark, folder)))


@query
def daily_complaint_trends(spark, folder):
    rows = complaint_marts.daily_trends(_assigned(spark, folder))
    ranking = written(
        "daily_cluster_ranking",
        lambda c: joined(c["cluster_name"], c["daily_complaint_count"], F.size(c["sample_complaints"])),
    )
    return tidy(rows.withColumn("sample_complaints", _sample_text()).withColumn("daily_cluster_ranking", ranking))


@query
def weekly_complaint_trends(spark, folder):
    return tidy(clusters.weekly_trends(_stats(spark, folder)))


@query
def dashboard_summary(spark, folder):
    rows = complaint_marts.dashboard_summary(_assigned(spark, folder), samples.AS_OF)
    latest = written(
        "recent_daily_samples",
        lambda d: joined(d["complaint_date"], d["daily_complaint_count"], F.size(d["sample_complaints"])),
    )
    top = written(
        "daily_top_clusters",
        lambda c: joined(
            c["cluster_name"], c["daily_complaint_count"],
            F.array_join(F.transform(c["top_complaints"], lambda t: t["complaint_id"]), "+"),
        ),
    )
    return tidy(rows.withColumn("recent_daily_samples", latest).withColumn("daily_top_clusters", top))


# ---------------------------------------------------------- serving queries
def _overview(spark, folder) -> DataFrame:
    return serving.cluster_overview(clusters.cluster_summary(_assigned(spark, folder)))


@query
def cluster_overview(spark, folder):
    return tidy(serving.overview_cards(_overview(spark, folder)))


@query
def kpi_tiles(spark, folder):
    return tidy(serving.kpi_tiles(_overview(spark, folder)))


@query
def overview_totals(spark, folder):
    return serving.overview_totals(_overview(spark, folder))


@query
def trend_rows(spark, folder):
    rows = serving.trend_rows(_stats(spark, folder))
    return tidy(rows.withColumn("sample_complaints", F.size("sample_complaints")))


@query
def date_rollup(spark, folder):
    return serving.date_rollup(_stats(spark, folder))


@query
def cluster_distribution(spark, folder):
    return serving.cluster_distribution(_stats(spark, folder))


@query
def top_categories(spark, folder):
    return serving.top_categories(_stats(spark, folder))


@query
def newest_samples(spark, folder):
    return tidy(serving.newest_samples(_stats(spark, folder)).drop("complaint_preview"))


@query
def newest_grave_samples(spark, folder):
    return tidy(serving.newest_samples(_stats(spark, folder), 5, "high").drop("complaint_preview"))


@query
def complaint_page(spark, folder):
    rows = serving.complaint_page(_assigned(spark, folder), "general_complaints", page=2, page_size=10)
    return rows.select("complaint_id", "source_type", "complaint_date", "severity_level", "cluster_name")


@query
def complaint_page_envelope(spark, folder):
    return serving.page_envelope(_assigned(spark, folder), "all", page=2, page_size=50)


def _page_index(spark, folder, group: str | None) -> page_index.PageIndex:
    path = scratch_path(spark, "pages")
    page_index.write_pages(serving.page_rows(_assigned(spark, folder)), path, serving.newest_first(), group)
    return page_index.PageIndex(spark, path)


@query
def complaint_places(spark, folder):
    """Every complaint with its place and page within its cluster, from the written pages."""
    rows = _page_index(spark, folder, "cluster_name").placed()
    return rows.select("complaint_id", "cluster_name", "place", F.ceil(F.col("place") / 50).alias("page"))


@query
def complaint_last_page(spark, folder):
    """The deepest page of all complaints."""
    index = _page_index(spark, folder, None)
    last = serving.envelope(index.total(), 1, 50).head().total_pages
    rows = index.page(max(last, 1), 50)
    return rows.select("complaint_id", "source_type", "complaint_date", "severity_level", "cluster_name")


@query
def complaint_severity_counts(spark, folder):
    return serving.severity_counts(_assigned(spark, folder))


# ------------------------------------------------------------------ ingest
@query
def event_identity(spark, folder):
    rows = samples.table(spark, folder, "conversations")
    kind = F.when(F.col("turn") == 0, "post").when(F.col("role") == "user", "comment").otherwise(F.col("role"))
    native = F.concat_ws("_", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return rows.select(social_event_id(kind, native).alias("event_id"), fingerprint(F.col("text")).alias("content_hash"))


def _mentions(spark, folder) -> DataFrame:
    docs = samples.table(spark, folder, "documents").select("doc_id", "text")
    return mentions.detect_mentions(docs, samples.MENTION_TERMS)


@query
def mention_detection(spark, folder):
    found = _mentions(spark, folder)
    return tidy(found.select("doc_id", "mention_brand", F.array_join("matched_terms", ",").alias("matched_terms"), "mention_score", "match_count"))


@query
def mention_acceptance(spark, folder):
    kept = mentions.accept_mentions(_mentions(spark, folder), "jpm")
    return tidy(kept.select("doc_id", F.col("brand_detection.confidence_score").alias("confidence_score"), F.col("brand_detection.match_count").alias("match_count")))


@query
def mention_positions(spark, folder):
    hits = mentions.mention_positions(_mentions(spark, folder), "doc_id", samples.MENTION_TERMS)
    return tidy(
        hits.groupBy("doc_id", "mention_brand", "term").agg(
            F.count(F.lit(1)).alias("hits"), F.count_if("word_boundary").alias("edged"),
            F.min("position").alias("first_position"), F.max("position").alias("last_position"),
            F.sum("position").alias("position_sum"), F.sum(F.length("context")).alias("context_chars"),
            F.avg("confidence").alias("confidence"),
        )
    )


@query
def simple_mentions(spark, folder):
    docs = samples.table(spark, folder, "documents")
    return docs.filter(mentions.mentions_any(F.lower("text"), ("Anon", "eau"))).select("doc_id", "lang")


COVERAGE_WORDS = ("Anon", "Eau", "und", "thou", "que")


@query
def keyword_coverage(spark, folder):
    return tidy(mentions.keyword_coverage(samples.table(spark, folder, "documents"), COVERAGE_WORDS))


@query
def keyword_hits(spark, folder):
    return mentions.keyword_hits(samples.table(spark, folder, "documents"), COVERAGE_WORDS)


@query
def keyword_suggestions(spark, folder):
    docs = samples.table(spark, folder, "documents")
    return mentions.suggest_keywords(docs, ("anon", "eau", "und"), ("The", "Ering", "Onen", "Les", "Ontion"), "er")


def _posts(spark, folder) -> DataFrame:
    c, size = F.col("conv_id"), F.length("text")
    return samples.table(spark, folder, "conversations").select(
        F.concat_ws("_", c.cast("string"), F.col("turn").cast("string")).alias("id"),
        "turn", "conv_id",
        F.when(F.col("turn") == 0, F.substring("text", 1, 30)).alias("title"),
        F.when(c % 4 != 0, F.col("text")).alias("selftext"),
        F.col("text").alias("body"),
        F.when(F.col("role") != "system", F.col("role")).alias("author"),
        F.timestamp_add("MINUTE", F.col("turn").cast("int"), samples.day_of(c).cast("timestamp")).alias("created_at"),
        samples.brand_of(c).alias("brand_id"),
        F.concat(F.lit("sub"), (c % 5).cast("string")).alias("subreddit"),
        (size % 21 - 5).alias("score"), (size % 7).alias("num_comments"),
        ((size % 100) / 100.0).cast("double").alias("upvote_ratio"),
        F.concat(F.lit("https://example.org/"), c.cast("string")).alias("url"),
        F.concat(F.lit("/r/"), c.cast("string")).alias("permalink"),
        F.concat(F.lit("t3_"), c.cast("string")).alias("parent_id"),
        F.lit(None).cast("boolean").alias("edited"),
    )


def _run_ts() -> Column:
    return F.lit(samples.RUN_TS).cast("timestamp")


@query
def normalised_messages(spark, folder):
    rows = _posts(spark, folder)
    posts = ingest.normalise_posts(rows.filter("turn = 0"), _run_ts(), "run-1")
    comments = ingest.normalise_comments(rows.filter("turn > 0"), _run_ts(), "run-1")
    meta = F.col("metadata")
    return posts.unionByName(comments).select(
        "event_id", "ts_event", "brand_id", F.length("text").alias("chars"), "content_hash",
        F.get_json_object(meta, "$.author").alias("author"),
        F.get_json_object(meta, "$.reddit_type").alias("kind"),
        F.get_json_object(meta, "$.permalink").alias("permalink"),
        F.get_json_object(meta, "$.parent_id").alias("parent_id"),
        F.get_json_object(meta, "$.edited").alias("edited"),
    )


@query
def first_comments(spark, folder):
    rows = samples.table(spark, folder, "conversations").filter("turn > 0")
    return ingest.first_comments(rows, "conv_id", "turn", 3).select("conv_id", "turn", "role")


SUPPLIER_BRANDS = (
    ("first", ("Supplier#000000001", "Supplier#000000015")),
    ("second", ("SUPPLIER#00000002", "Supplier#000000001x")),
    ("third", ("#0000000", "supplier#000000099 inc.")),
)


@query
def company_brands(spark, folder):
    rows = samples.table(spark, folder, "supplier")
    return rows.select("s_suppkey", ingest.company_brand(F.col("s_name"), SUPPLIER_BRANDS).alias("brand_id"))


@query
def normalised_complaints(spark, folder):
    rows = samples.complaints_feed(spark, folder).select(
        "complaint_id", F.concat(F.lit("Bank of "), "state").alias("company"), "product", "issue", "sub_issue",
        "state", "zip_code", "consumer_complaint_narrative",
        F.when(F.col("consumer_disputed"), F.lit("unknown")).otherwise(F.substring("ts_event", 1, 10)).alias("date_received"),
    )
    names = (("one", ("BANK OF NATION_1",)), ("two", ("Nation_2", "BANK OF NATION_3 AND SONS")))
    out = ingest.normalise_complaints(rows, names, _run_ts(), "run-1")
    return out.select("event_id", "ts_event", "brand_id", "content_hash", fingerprint(F.col("text")).alias("text_hash"), F.get_json_object("metadata", "$.state").alias("state"))


@query
def flattened_tweets(spark, folder):
    events, customers, nations = (samples.table(spark, folder, n) for n in ("events", "customer", "nation"))
    user = F.col("user_id")
    tweets = events.select(
        F.col("event_id").alias("id"), samples.brand_of(user).alias("brand_id"), F.col("ts").alias("created_at"),
        (user + 10).alias("author_id"), F.when(user % 3 != 0, user % 40).alias("geo_place_id"),
        F.col("event_type").alias("text"), F.lit(None).cast("string").alias("lang"),
        *[(F.col("event_id") % n).alias(c) for n, c in ((7, "like_count"), (5, "reply_count"), (3, "retweet_count"), (2, "quote_count"))],
        F.when(F.col("event_type") == "error", F.lit(True)).alias("possibly_sensitive"),
    )
    users = customers.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("username"),
        F.when(F.col("c_acctbal") > 0, F.lit(True)).alias("verified"), F.col("c_mktsegment").alias("location"),
    )
    places = nations.select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("country"))
    return ingest.flatten_tweets(tweets, users, places, _run_ts())


@query
def trend_terms(spark, folder):
    brands = samples.table(spark, folder, "part").select(
        F.col("p_brand").alias("brand_id"), F.array("p_brand", F.concat("p_brand", F.lit(" Inc"))).alias("brand_terms")
    ).distinct()
    return ingest.expand_trend_terms(brands)


@query
def related_queries(spark, folder):
    points = samples.trends_feed(spark, folder).groupBy("brand_id", "keyword").agg(F.sum("value").alias("value"))
    related = samples.table(spark, folder, "part").select(
        F.col("p_brand").alias("keyword"), F.col("p_name").alias("query"), F.col("p_partkey").alias("position")
    )
    rows = ingest.attach_related(points, related, ["keyword"])
    return rows.withColumn("related_queries_top", F.array_join("related_queries_top", ","))


@query
def trending_searches(spark, folder):
    searches = samples.trends_feed(spark, folder).groupBy("geo", F.col("keyword").alias("query")).agg(F.sum("value").alias("volume"))
    return ingest.trending(searches)


def _raw_reviews(spark, folder) -> DataFrame:
    """Customers as reviewers: JSON with the field names sources really use."""
    key, odd = F.col("c_custkey"), F.col("c_custkey") % 2 == 1
    day = samples.day_of(key)
    when = (
        F.when(key % 5 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(key % 5 == 1, F.date_format(day, "MM/dd/yyyy"))
        .when(key % 5 == 2, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T10:11:12Z")))
        .when(key % 5 == 3, F.lit("last week"))
    )
    stars = (key % 5 + 1).cast("string")
    document = F.to_json(
        F.struct(
            F.when(odd, when).alias("review_date"), F.when(~odd, when).alias("date"),
            F.concat(F.lit("r"), key.cast("string")).alias("id"),
            F.when(odd, stars).alias("rating"), F.when(~odd, stars).alias("overall_rating"),
            F.when(key % 3 == 0, F.lit("n/a")).otherwise((key % 4 + 1).cast("string")).alias("culture_values_rating"),
            F.when(key % 4 == 0, F.lit("0.8")).when(key % 4 == 1, F.lit("80")).when(key % 4 == 2, F.lit("150")).otherwise(F.lit("x")).alias("approve_of_ceo"),
            F.element_at(F.array(F.lit("Current Employee"), F.lit("FORMER employee"), F.lit("Intern"), F.lit("Contractor")), (key % 4 + 1).cast("int")).alias("status"),
            F.col("c_mktsegment").alias("headline"), F.col("c_name").alias("pros"),
            F.when(odd, F.lit("too slow")).alias("advice_to_mgmt"),
        )
    )
    return samples.table(spark, folder, "customer").select(
        samples.brand_of(F.col("c_nationkey")).alias("brand_id"), F.lit("42").alias("company_id"), document.alias("raw")
    )


def _reviews(spark, folder) -> DataFrame:
    return ingest.normalise_reviews(_raw_reviews(spark, folder), _run_ts())


@query
def normalised_reviews(spark, folder):
    return tidy(_reviews(spark, folder).select("brand_id", "review_id", "ts_event", "overall_rating", "culture_values", "ceo_approval", "employment_status", "review_title", "review_text"))


@query
def undated_reviews(spark, folder):
    rejected = ingest.undated_reviews(_raw_reviews(spark, folder))
    return rejected.select("brand_id", F.get_json_object("raw", "$.id").alias("review_id"))


@query
def review_index(spark, folder):
    rows = scoring.employee_review_index(ingest.reviews_by_day(_reviews(spark, folder)))
    return tidy(rows.select("brand_id", "date", "country", "review_count", "rating_avg", "culture_values", "ceo_approval", "employee_review_index"))


@query
def approval_scaling(spark, folder):
    price = F.col("l_discount") * F.when(F.col("l_linenumber") % 2 == 0, 1000).otherwise(1)
    rows = samples.table(spark, folder, "lineitem").select(approval_share(price.cast("string")).alias("approval"))
    return tidy(rows.groupBy(F.round("approval", 6).alias("approval")).agg(F.count(F.lit(1)).alias("n")))


# ------------------------------------------------- versions, merges, cursors
@query
def latest_versions(spark, folder):
    rows = samples.event_versions(spark, folder)
    return tidy(versions.latest_version(rows, ["event_id"], versions.EVENT_RECENCY))


@query
def duplicate_audit(spark, folder):
    rows = samples.event_versions(spark, folder)
    return versions.duplicate_audit(rows, versions.latest_version(rows, ["event_id"], versions.EVENT_RECENCY), "event_id")


@query
def duplicate_rate(spark, folder):
    return versions.duplicate_rate(samples.event_versions(spark, folder), "event_id")


@query
def most_duplicated(spark, folder):
    return versions.most_duplicated(samples.event_versions(spark, folder), "event_id")


def _stored_and_incoming(spark, folder) -> tuple[DataFrame, DataFrame]:
    events = samples.table(spark, folder, "events")
    columns = ["event_id", F.col("ts").alias("ts_event"), F.lit(None).cast("timestamp").alias("edited"), F.col("event_type").alias("text"), "value"]
    stored = events.filter("event_type <> 'signup'").select(*columns)
    incoming = events.filter("event_type in ('signup', 'error', 'click')").select(
        "event_id", F.col("ts").alias("ts_event"),
        F.when(F.col("event_type") == "error", F.timestamp_add("HOUR", F.lit(1), F.col("ts"))).alias("edited"),
        F.lit("again").alias("text"), "value",
    )
    return stored, incoming


@query
def insert_only_new(spark, folder):
    stored, incoming = _stored_and_incoming(spark, folder)
    return tidy(versions.only_new(incoming, stored, ["event_id"]))


@query
def merge_events(spark, folder):
    stored, incoming = _stored_and_incoming(spark, folder)
    return tidy(versions.merge_latest(stored, incoming, ["event_id"], F.coalesce("edited", "ts_event")))


@query
def merge_trends(spark, folder):
    points = samples.trends_feed(spark, folder)
    keys = ["brand_id", "keyword", "geo", "ts_event"]
    stored = points.filter("value < 60").groupBy(*keys).agg(F.max("value").alias("value"), F.lit("a").alias("load"))
    again = points.filter("value >= 40").groupBy(*keys).agg(F.max("value").alias("value"), F.lit("b").alias("load"))
    return versions.merge_latest(stored, again, keys, F.col("load"))


def _state(spark, folder) -> DataFrame:
    """State rows as runs append them: one per event of a kind."""
    return samples.table(spark, folder, "events").select(
        F.concat(F.lit("reddit_"), "event_type").alias("source"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("cursor_iso"),
        F.col("event_id").cast("string").alias("tie_breaker_id"),
        F.timestamp_add("MINUTE", F.col("user_id").cast("int"), F.col("ts")).alias("updated_at"),
    )


@query
def ingest_state(spark, folder):
    return cursors.latest_state(_state(spark, folder))


@query
def fetch_cutoffs(spark, folder):
    rows = samples.table(spark, folder, "events")
    asked = F.when(F.col("user_id") % 3 == 0, F.col("user_id") * 100)
    cursor = F.when(F.col("user_id") % 3 == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    initial = F.col("user_id") % 5 == 0
    return rows.select("event_id", cursors.fetch_cutoff(asked, cursor, _run_ts(), initial=initial).alias("cutoff"))


@query
def cursor_advance(spark, folder):
    state = _state(spark, folder).filter("source in ('reddit_view', 'reddit_error', 'reddit_click')")
    events = samples.table(spark, folder, "events")
    # Signups arrive at the stored time, some with a larger id; purchases with none.
    tie = events.filter("event_type in ('signup', 'purchase')").groupBy("event_type").agg(
        F.min(F.col("event_id").cast("string")).alias("low"), F.max(F.col("event_id").cast("string")).alias("high")
    )
    state = state.unionByName(tie.select(
        F.concat(F.lit("reddit_"), "event_type").alias("source"), F.lit("2024-01-05T00:00:00Z").alias("cursor_iso"),
        F.when(F.col("event_type") == "signup", F.col("low")).otherwise(F.col("high")).alias("tie_breaker_id"),
        _run_ts().alias("updated_at"),
    ))
    accepted = events.select(
        F.concat(F.lit("reddit_"), "event_type").alias("source"),
        F.when(F.col("event_type") == "click", F.timestamp_add("DAY", F.lit(-60), F.col("ts")))
        .when(F.col("event_type").isin("signup", "purchase"), F.lit("2024-01-05 00:00:00.25").cast("timestamp"))
        .otherwise(F.timestamp_add("HOUR", F.lit(5), F.col("ts"))).alias("ts_event"),
        F.col("event_id").alias("native_id"),
    )
    return cursors.advance_cursor(accepted, state, _run_ts())


@query
def run_report(spark, folder):
    rows = samples.reddit_events_feed(spark, folder)
    return cursors.run_report(rows).withColumn("brands_found", F.array_join("brands_found", ","))


# -------------------------------------------------------------- enrichment
ENRICH = EnrichSettings(
    positive=("ering", "onen", "les", "und"), negative=("thou", "elle", "der", "anon"),
    severe=("ontion", "eau", "erst"), topics=("of_the", "the_on", "le_les", "der_die", "ering", "que", "and_the"),
)


def _enriched(spark, folder) -> DataFrame:
    docs = samples.table(spark, folder, "documents").select("doc_id", "text")
    return enrich.enrich(docs, _run_ts(), cfg=ENRICH)


@query
def enriched_texts(spark, folder):
    rows = _enriched(spark, folder)
    return tidy(rows.withColumn("topics", F.array_join("topics", ",")).drop("text"))


@query
def enriched_messages(spark, folder):
    rows = _posts(spark, folder)
    text = enrich.chosen_text(F.col("title"), F.col("selftext"), F.lit(None).cast("string"))
    out = enrich.enrich(rows, _run_ts(), text, ENRICH)
    return tidy(out.select("id", "sentiment", "severity", F.array_join("topics", ",").alias("topics"), "nlp_confidence"))


def _length_scorer(texts):
    import pandas as pd

    size = texts.str.len()
    return pd.DataFrame(
        {
            "sentiment": (size % 11 - 5) / 5.0, "severity": (size % 7) / 7.0,
            "topics": [["long"] if n > 500 else [] for n in size], "language": "en", "confidence": 0.9,
        }
    )


@query
def plugged_scorer(spark, folder):
    docs = samples.table(spark, folder, "conversations").select("conv_id", "turn", "text")
    out = enrich.score_with(docs, _length_scorer, "length", "v2", _run_ts(), cfg=ENRICH)
    return tidy(out.withColumn("topics", F.array_join("topics", ",")).drop("text"))


@query
def parsed_responses(spark, folder):
    rows = samples.table(spark, folder, "events")
    answer = F.when(F.col("event_type") == "view", F.lit("sorry, no idea")).otherwise(
        F.concat(
            F.lit('Result:\n{"sentiment": '), F.col("value").cast("string"), F.lit(', "severity": '),
            (F.col("value") / -100 + 1).cast("decimal(10,4)").cast("string"),
            F.when(F.col("event_type") == "click", F.lit("")).otherwise(F.lit(', "confidence": 0.25')),
            F.lit(', "topics": ["a","b","c","'), F.col("event_type"), F.lit('"]} done'),
        )
    )
    parsed = rows.select("event_id", enrich.parse_response(answer).alias("p")).select("event_id", "p.*")
    return tidy(parsed.withColumn("topics", F.array_join("topics", ",")))


@query
def redacted_documents(spark, folder):
    docs = samples.table(spark, folder, "documents")
    return docs.select("doc_id", fingerprint(redact(F.col("text"))).alias("text_hash"), F.length(redact(F.col("text"))).alias("chars"))


# --------------------------------------------------------------- retrieval
def _search_table(spark, folder, vectors=False, columns=("*",)) -> DataFrame:
    """Analysed documents, written once as the search table."""
    rows = samples.search_events(spark, folder)
    table = search.search_table(rows if vectors else rows.drop("dense_vec"))
    return stage(table.select(*columns), "search")


@query
def search_extract(spark, folder):
    rows = search.search_extract(samples.reddit_events_feed(spark, folder))
    return tidy(rows.withColumn("topics", F.array_join("topics", ",")).drop("text"))


@query
def analysed_tokens(spark, folder):
    docs = samples.table(spark, folder, "documents").select("doc_id", "text")
    tokens = search.search_table(docs, hide_personal=False)
    return tokens.select("doc_id", "token_count", fingerprint(F.array_join("tokens", " ")).alias("token_hash"))


@query
def stemmed_tokens(spark, folder):
    docs = samples.table(spark, folder, "documents").select("doc_id", "text")
    tokens = search.search_table(docs, hide_personal=False, stem="porter")
    return tokens.select("doc_id", "token_count", fingerprint(F.array_join("tokens", " ")).alias("token_hash"))


@query
def relevance_match(spark, folder):
    hits = search.top_matches(_search_table(spark, folder), "ering reons")
    return tidy(hits.select("event_id", "score"))


@query
def relevance_scores(spark, folder):
    scored = search.relevance(_search_table(spark, folder), "eau ontion thou")
    return tidy(scored.filter("score > 0").select("event_id", "score"))


def _postings(spark, folder) -> postings.Postings:
    """The search table's postings, written once from its tokens."""
    tokens = _search_table(spark, folder, columns=("event_id", "tokens", "token_count"))
    return postings.write_postings(tokens, scratch_path(spark, "postings"))


@query
def postings_match(spark, folder):
    return tidy(postings.best_matching(spark, _postings(spark, folder), "ering reons"))


@query
def postings_scores(spark, folder):
    return tidy(postings.matching(spark, _postings(spark, folder), "eau ontion thou"))


@query
def filtered_match(spark, folder):
    hits = search.top_matches(_search_table(spark, folder), "ontion thou", where=F.col("brand_id") == "wf")
    return tidy(hits.select("event_id", "brand_id", "score"))


@query
def newest_match(spark, folder):
    where = F.col("sentiment").between(-1, 1)
    hits = search.top_matches(_search_table(spark, folder), "ontion", 3, where, newest=True)
    return tidy(hits.select("event_id", "ts_event", "score"))


@query
def sentiment_range(spark, folder):
    rows = search.by_range(samples.search_events(spark, folder), "sentiment", -1.0, -0.5)
    return tidy(rows.select("event_id", "brand_id", "sentiment"))


@query
def evidence_quotes(spark, folder):
    table, since = _search_table(spark, folder), F.lit("2024-01-05").cast("timestamp")
    rows = search.evidence(table, "fr", ("jpm", "bac"), since)
    more = search.evidence(table, "eau thou", ("jpm", "bac"), since)
    both = rows.withColumn("asked", F.lit("fr")).unionByName(more.withColumn("asked", F.lit("eau thou")))
    return tidy(both.drop("text"))


@query
def search_facets(spark, folder):
    return tidy(search.facets(samples.search_events(spark, folder)))


def _query_vector(spark, folder) -> Column:
    """Mean vector of one label, as a scalar subquery."""
    e = samples.table(spark, folder, "embeddings").filter("label = 3")
    parts = e.select(F.posexplode("embedding").alias("i", "x")).groupBy("i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    listed = F.array_sort(F.collect_list(F.struct("i", "x")))
    return parts.agg(F.transform(listed, lambda p: p["x"]).alias("v")).scalar()


@query
def nearest_vectors(spark, folder):
    vectors = samples.table(spark, folder, "embeddings")
    rows = search.nearest(vectors, _query_vector(spark, folder), 100, "vec_id", "embedding")
    return tidy(rows.select("vec_id", "label", "similarity"))


@query
def probed_vectors(spark, folder):
    """Recall of the approximate neighbours of every fiftieth vector against all rows."""
    vectors = samples.table(spark, folder, "embeddings")
    index = vector_index.write_vectors(vectors, scratch_path(spark, "vectors"), "vec_id", "embedding", lists=32)
    return tidy(vector_index.recall(spark, index, vectors.filter("vec_id % 50 = 0"), "embedding", 100))


@query
def nearest_vectors_indexed(spark, folder):
    """All lists and candidates: the exact way through the index."""
    vectors = samples.table(spark, folder, "embeddings")
    index = vector_index.write_vectors(vectors, scratch_path(spark, "vectors"), "vec_id", "embedding")
    rows = vector_index.search(spark, index, _query_vector(spark, folder), 100, None, None)
    return tidy(rows)


@query
def hybrid_match(spark, folder):
    rows = search.hybrid(
        _search_table(spark, folder, vectors=True), "ering thou", _query_vector(spark, folder),
        F.col("ts_event") >= F.lit("2024-01-06").cast("timestamp"), limit=20,
    )
    return tidy(rows.select("event_id", "text_score", "vector_score", "score"))


@query
def diverse_quotes(spark, folder):
    rows = samples.search_events(spark, folder).filter("dense_vec is not null").select(
        "event_id", "label", "dense_vec", F.col("severity").alias("relevance")
    )
    return tidy(search.diverse(rows, "label", "event_id", "relevance", "dense_vec", limit=10))


@query
def metric_contributors(spark, folder):
    rows = _events(spark, folder).withColumn("topic", F.explode("topics"))
    parts = [
        search.contributors(rows, "topic", "event_date", "2024-01-20"),
        search.contributors(_events(spark, folder), "geo_country", "event_date", "2024-01-20"),
        search.contributors(_events(spark, folder), "source", "event_date", "2024-01-20"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ------------------------------------------------------- monitors, reports
@query
def top_states(spark, folder):
    return monitors.top_states(_exports(spark, folder))


@query
def complaint_mix(spark, folder):
    rows = features.unified_complaints(_events(spark, folder), _exports(spark, folder)).select("source_type", "severity_level")
    return tidy(monitors.share_of_total(rows, "source_type").unionByName(monitors.share_of_total(rows, "severity_level")))


@query
def peak_days(spark, folder):
    rows = monitors.peak_days(_stats(spark, folder))
    return rows.withColumn("top_clusters", written("top_clusters", lambda c: joined(c["cluster_name"], c["n"])))


def _loaded(spark, folder) -> dict[str, DataFrame]:
    feeds = {
        "twitter": samples.twitter_feed(spark, folder), "reddit": samples.reddit_feed(spark, folder),
        "trends": samples.trends_feed(spark, folder), "cfpb": samples.complaints_feed(spark, folder),
    }
    return {n: f.select(F.to_timestamp("collected_at").alias("collected_at")) for n, f in feeds.items()}


@query
def feed_freshness(spark, folder):
    return monitors.freshness(_loaded(spark, folder), _run_ts())


@query
def feed_synced_today(spark, folder):
    return monitors.synced_today(_loaded(spark, folder), F.lit("2024-01-15").cast("date"))


@query
def topic_weeks(spark, folder):
    return tidy(monitors.topic_weeks(_events(spark, folder)))


@query
def topic_shares(spark, folder):
    return tidy(monitors.topic_shares(_events(spark, folder)))


@query
def share_of_voice(spark, folder):
    return tidy(monitors.share_of_voice(raw.trends_timeseries(samples.trends_feed(spark, folder))))


@query
def intent_tiers(spark, folder):
    return tidy(monitors.intent_tiers(raw.trends_timeseries(samples.trends_feed(spark, folder))))


@query
def volume_alerts(spark, folder):
    rows = raw.complaints(samples.complaints_feed(spark, folder)).groupBy("brand_id", "date").agg(
        F.count(F.lit(1)).alias("complaints"), F.avg("severity_score").alias("severity")
    )
    return tidy(monitors.alerts(rows))


# ------------------------------------------------------------ data quality
@query
def quality_report(spark, folder):
    parts = [
        quality.run_checks(samples.twitter_feed(spark, folder), "twitter_posts", quality.TWITTER_CHECKS),
        quality.run_checks(samples.reddit_feed(spark, folder), "reddit_messages", quality.REDDIT_CHECKS),
        quality.run_checks(samples.trends_feed(spark, folder), "trends_timeseries", quality.TRENDS_CHECKS),
        quality.run_checks(samples.complaints_feed(spark, folder), "cfpb_complaints", quality.COMPLAINT_CHECKS),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def quality_violations(spark, folder):
    """The same checks on rows that break them."""
    checks = (
        quality.NotNull("nlp_processed_at"), quality.Unique(("event_id",)), quality.Unique(("event_id", "ts_event")),
        quality.AcceptedValues("text", ("view", "click", "signup")), quality.AcceptedRange("value", 1, 100),
    )
    return quality.run_checks(samples.event_versions(spark, folder), "event_versions", checks)


@query
def score_quality(spark, folder):
    scores = stage(scoring.composite_score(_metrics(spark, folder)), "scores")
    return quality.run_checks(scores, "composite_score", quality.SCORE_CHECKS)


# ------------------------------------------------------- storage, streaming
def _landed(spark, folder) -> DataFrame:
    return samples.table(spark, folder, "events").select(
        F.concat(F.lit("reddit_t3_"), F.col("event_id").cast("string")).alias("event_id"),
        F.col("ts").alias("ts_event"), samples.brand_of(F.col("user_id")).alias("brand_id"),
        F.col("event_type").alias("text"), F.col("value"),
    )


LANDED = "event_id string, ts_event timestamp, brand_id string, text string, value double"


@query
def landing_roundtrip(spark, folder):
    path = scratch_path(spark, "landing")
    landing.write_landing(_landed(spark, folder), path)
    return tidy(landing.read_landing(spark, path, LANDED, DateRange("2024-01-03", "2024-01-20")))


@query
def landed_posts_in_range(spark, folder):
    """A date range over landed posts reads only the day folders around it."""
    path = scratch_path(spark, "landing")
    landing.write_landing(samples.twitter_feed(spark, folder), path)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in samples.twitter_feed(spark, folder).schema)
    feed = landing.read_landing(spark, path, schema)
    posts = raw.twitter_posts(feed, DateRange("2024-01-05", "2024-01-09"))
    return tidy(posts.select("tweet_id", "brand_id", "date", "total_engagements", "text_length"))


@query
def dictionary_from_file(spark, folder):
    """A brand dictionary file with one brand per nation."""
    path = scratch_path(spark, "brands")
    listed = lambda *parts: F.to_json(F.array(*parts))
    samples.table(spark, folder, "nation").select(
        F.lower("n_name").alias("brand_id"), F.concat("n_name", F.lit(", Bank")).alias("brand_name"),
        listed("n_name", F.lit("x, y")).alias("aliases"), listed(F.concat(F.lower("n_name"), F.lit(".example"))).alias("domains"),
        F.substring("n_name", 1, 3).alias("ticker"), F.lit("US").alias("hq_country"),
    ).write.option("header", True).option("escape", '"').csv(path)
    rows = dimensions.read_brand_dictionary(spark, path)
    return rows.select("brand_id", "brand_name", F.array_join("aliases", "|").alias("aliases"), F.array_join("domains", "|").alias("domains"), "ticker", "hq_country")


@query
def registered_sources(spark, folder):
    tables.register_sources(spark, {"event_source": samples.table(spark, folder, "events"), "nation_source": f"{folder}/nation.parquet"})
    return spark.sql(
        "select event_type as name, count(*) n from event_source group by 1 union all select n_name, count(*) from nation_source group by 1"
    )


@query
def replaced_with_backup(spark, folder):
    """Duplicates removed in place; the table as it was stays beside it."""
    path, backup = scratch_path(spark, "table"), scratch_path(spark, "backup")
    samples.event_versions(spark, folder).write.parquet(path)
    once = versions.latest_version(spark.read.parquet(path), ["event_id"], versions.EVENT_RECENCY)
    now = tables.replace_with_backup(once, path, backup)
    counted = lambda df, name: df.groupBy("text").agg(F.count(F.lit(1)).alias("n")).withColumn("stored", F.lit(name))
    return counted(now, "table").unionByName(counted(spark.read.parquet(backup), "backup"))


@query
def brand_day_roundtrip(spark, folder):
    path = scratch_path(spark, "brand-days")
    landing.write_brand_days(_landed(spark, folder), path)
    back = spark.read.schema("event_id string, text string, value double, date date, brand_id string").json(path)
    return tidy(back.groupBy("date", "brand_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")))


@query
def mart_roundtrip(spark, folder):
    path = scratch_path(spark, "mart")
    tables.write_mart(brand_score.complaints_table(samples.complaints_feed(spark, folder)), path)
    stored = spark.read.parquet(path).filter(F.col("date") >= F.lit("2024-01-20").cast("date"))
    return tidy(stored.select("brand_id", "date", "country", "complaints", "complaints_index"))


@query
def upserted_table(spark, folder):
    path = scratch_path(spark, "upsert")
    rows = samples.event_versions(spark, folder).withColumn("dt", F.to_date("ts_event"))
    for part in ("text not in ('edited', 'copy')", "text in ('edited', 'copy')"):
        tables.upsert(spark, path, rows.filter(part), ["event_id"], versions.EVENT_RECENCY)
    return tidy(spark.read.parquet(path).select("event_id", "ts_event", "nlp_processed_at", "text", "value"))


@query
def upserted_ties(spark, folder):
    """Half of the incoming rows carry the stored stamp; those stay out."""
    path = scratch_path(spark, "upsert")
    rows = _landed(spark, folder).withColumn("dt", F.to_date("ts_event"))
    tied = F.regexp_extract("event_id", r"(\d+)$", 1).cast("bigint") % 2 == 0
    stamp = F.when(tied, F.col("ts_event")).otherwise(F.timestamp_add("SECOND", F.lit(1), F.col("ts_event")))
    tables.upsert(spark, path, rows, ["event_id"], ["ts_event"])
    changed = rows.filter("value > 20").withColumns({"ts_event": stamp, "text": F.lit("changed")})
    tables.upsert(spark, path, changed, ["event_id"], ["ts_event"])
    return tidy(spark.read.parquet(path).select("event_id", "ts_event", "text", "value"))


@query
def appended_events(spark, folder):
    path = scratch_path(spark, "append")
    rows = _landed(spark, folder).withColumn("dt", F.to_date("ts_event"))
    tables.append_new(spark, path, rows.filter("value < 60"), ["event_id"])
    tables.append_new(spark, path, rows.unionByName(rows.filter("value < 10")), ["event_id"])
    return tidy(spark.read.parquet(path).select("event_id", "ts_event", "brand_id", "text", "value"))


@query
def re_enriched_days(spark, folder):
    """Members outside the schema and lines that are not JSON survive."""
    path = scratch_path(spark, "re-enrich")
    rows = samples.reddit_events_feed(spark, folder).select("event_id", "ts_event", "text", "sentiment", "severity")
    landing.write_landing(rows.withColumn("extra", F.struct(F.length("text").alias("chars"))), path)
    bad = rows.select(F.concat(F.lit("not json "), F.col("event_id")).alias("value"), F.to_date("ts_event").alias("dt"))
    bad.write.mode("append").partitionBy("dt").text(path)
    enrich.re_enrich(spark, path, DateRange("2024-01-10", "2024-01-12"), _run_ts(), ENRICH)
    schema = "event_id string, ts_event timestamp, text string, sentiment double, severity double, extra struct<chars:int>"
    stored = landing.read_landing(spark, path, schema)
    lines = spark.read.schema("value string, dt date").text(path).filter("value like 'not json %'")
    good = stored.select("event_id", "sentiment", "severity", F.col("extra.chars").alias("chars"))
    other = lines.select(F.substring("value", 10, 200).alias("event_id"), *[F.lit(None).cast(t).alias(n) for n, t in (("sentiment", "double"), ("severity", "double"), ("chars", "int"))])
    return tidy(good.unionByName(other))


def _in_runs(spark, folder, job: Callable[[DataFrame], StreamingQuery]) -> None:
    """Land the events in three parts, each over all days, and run the job after each: two parts are late."""
    path = scratch_path(spark, "landing")
    rows = _landed(spark, folder)
    for part in range(3):
        again = rows.filter(F.abs(F.hash("event_id")) % 12 == part)  # some arrive a second time
        landing.write_landing(rows.filter(F.abs(F.hash("event_id")) % 3 == part).unionByName(again), path)
        job(jobs.landing_stream(spark, path, LANDED)).awaitTermination()


@query
def stream_deduplicated(spark, folder):
    """Events that land late and repeatedly, each kept once."""
    out, state = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-state")
    _in_runs(spark, folder, lambda s: jobs.append_unique(s, out, state))
    return tidy(spark.read.parquet(out).select("event_id", "ts_event", "brand_id", "text", "value"))


@query
def stream_upserted(spark, folder):
    out, state = scratch_path(spark, "stream-table"), scratch_path(spark, "stream-state")
    _in_runs(spark, folder, lambda s: jobs.upsert_events(s, out, state, ["event_id"], ["ts_event"]))
    return tidy(spark.read.parquet(out).select("event_id", "ts_event", "brand_id", "value"))


def _daily_tables(spark) -> jobs.DailyTables:
    return jobs.DailyTables(scratch_path(spark, "stream-events"), scratch_path(spark, "stream-daily"))


@query
def stream_daily(spark, folder):
    out, state = _daily_tables(spark), scratch_path(spark, "stream-state")
    _in_runs(spark, folder, lambda s: jobs.publish_daily(s, out, state, F.col("value")))
    return tidy(spark.read.parquet(out.daily).select("date", "brand_id", "volume", "mean_value"))


@query
def stream_rollup(spark, folder):
    """Daily figures merged from parts, two of three runs late; the sketch is compared in the tests."""
    out, state = scratch_path(spark, "stream-rollup"), scratch_path(spark, "stream-state")
    named = jobs.RollupColumns(member="text")
    _in_runs(spark, folder, lambda s: jobs.publish_rollup(s, out, state, F.col("value"), named, compact_every=2))
    return tidy(rollups.Rollup(spark, out, jobs.ROLLUP_GROUPS).read().drop("members_estimate"), 6)


@query
def stream_alerts(spark, folder):
    out, found, state = _daily_tables(spark), scratch_path(spark, "stream-alerts"), scratch_path(spark, "stream-state")
    _in_runs(spark, folder, lambda s: jobs.alert_on_spikes(s, out, found, state, F.col("value")))
    return tidy(spark.read.parquet(found).filter("alert").select("date", "brand_id", "volume", "previous_volume", "change_pct"))
