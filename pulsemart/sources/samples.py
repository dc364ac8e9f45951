"""The feeds, derived from the star-schema, text and vector test tables.

Every adapter keeps all rows of its base tables: modulo arithmetic only assigns
brands, days and countries.  One brand gets more than a third of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulsemart.settings import FeatureSettings, ToneLexicon
from pulsemart.sources.layout import in_tasks, spread

DAY0 = "2024-01-01"
SPAN = 35
AS_OF = "2024-02-05"
RUN_TS = "2024-02-05 06:30:00"
BRAND_IDS = ("jpm", "wf", "bac", "c", "gs", "ms", "td")

# Words that occur in the generated texts stand in for the finance vocabulary.
TONE = ToneLexicon(positive=("ering", "onen"), negative=("thou", "elle", "der"), toxic=("eau", "anon"))
COMPLAINT_WORDS = ("thou", "elle", "eux", "und")
SEVERITY_WORDS = (("high", ("anon", "ichau")), ("medium", ("erst", "eau")))
FEATURES = FeatureSettings(
    words=(
        ("account_terms", ("ontion", "les")),
        ("card_terms", ("onen", "der")),
        ("loan_terms", ("ering", "die")),
        ("fee_terms", ("eran", "eux")),
        ("channel_terms", ("erst", "elle")),
        ("fraud_terms", ("thanedble", "reon")),
        ("service_terms", ("of the", "que la")),
        ("error_terms", ("anea", "tre")),
        ("closure_terms", ("onhe", "pa")),
        ("dispute_terms", ("erti", "des")),
        ("negative_sentiment", ("thth", "ment")),
        ("emotional_terms", ("thou", "eau")),
    ),
    patterns=(("inability_terms", "th.on|ionen"), ("frequency_terms", "onre|avec")),
)
MENTION_TERMS = {
    "jpm": ("the", "Thou", "of the", "ering"),
    "wf": ("le", "les", "que la"),
    "bac": ("und", "der", "der die"),
}


# Tables whose rows are worth spreading, with the columns to spread by.
SPREAD_BY = {
    "documents": ("doc_id",), "conversations": ("conv_id", "turn"), "lineitem": ("l_orderkey", "l_linenumber"),
    "orders": ("o_orderkey",), "events": ("event_id",), "embeddings": ("vec_id",),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(rows, *SPREAD_BY[name]) if name in SPREAD_BY else rows


def brand_of(number: Column) -> Column:
    """Brand for a number; every third number goes to the first brand."""
    place = F.when(number % 3 == 0, F.lit(0)).otherwise(number % 7)
    return F.element_at(F.array(*[F.lit(b) for b in BRAND_IDS]), place.cast("int") + 1)


def day_of(number: Column) -> Column:
    return F.date_add(F.lit(DAY0).cast("date"), F.pmod(number, F.lit(SPAN)).cast("int"))


def iso(day: Column, clock: Column | None = None) -> Column:
    clock = F.lit("08:15:00") if clock is None else clock
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T"), clock)


def country_of(number: Column) -> Column:
    return F.when(number % 4 <= 1, "US").when(number % 4 == 2, "CA")


def twitter_feed(spark: SparkSession, folder: str) -> DataFrame:
    """One post per event; the document of the same number is the text, else the event's kind."""
    docs, events = table(spark, folder, "documents"), table(spark, folder, "events")
    user, at = F.col("user_id"), iso(day_of(F.col("event_id")), F.date_format("ts", "HH:mm:ss"))
    return events.join(docs, docs["doc_id"] == events["event_id"], "left").select(
        brand_of(user).alias("brand_id"),
        F.col("event_id").cast("string").alias("tweet_id"),
        at.alias("ts_event"),
        user.cast("string").alias("author_id"),
        F.concat(F.lit("user"), user.cast("string")).alias("author_username"),
        (user % 10 == 0).alias("author_verified"),
        F.lit(None).cast("string").alias("author_location"),
        F.coalesce("text", "event_type").alias("text"), F.coalesce("lang", F.lit("en")).alias("lang"),
        F.floor(F.col("value") / 10).cast("bigint").alias("like_count"),
        (user % 5).cast("bigint").alias("reply_count"),
        F.floor(F.col("value") / 50).cast("bigint").alias("retweet_count"),
        F.when(F.col("event_type") != "signup", F.lit(0)).cast("bigint").alias("quote_count"),
        (F.col("event_type") == "error").alias("possibly_sensitive"),
        country_of(user).alias("geo_country"),
        F.lit(None).cast("string").alias("geo_place_id"),
        at.alias("collected_at"),
    )


def reddit_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Turn 0 of a conversation is the post, later turns are comments."""
    c, first = F.col("conv_id"), F.col("turn") == 0
    size = F.length("text")
    at = iso(day_of(c))
    return table(spark, folder, "conversations").select(
        brand_of(c).alias("brand_id"),
        F.concat_ws("_", c.cast("string"), F.col("turn").cast("string")).alias("reddit_id"),
        at.alias("ts_event"),
        F.concat(F.lit("sub"), (c % 5).cast("string")).alias("subreddit"),
        F.when(F.col("role") == "system", "[deleted]").otherwise(F.concat(F.col("role"), (size % 9).cast("string"))).alias("author"),
        F.when(first, "post").otherwise("comment").alias("type"),
        F.when(first, F.substring("text", 1, 40)).alias("title"),
        F.when(~(first & (c % 3 == 0)), F.col("text")).alias("body"),
        (size % 21 - 5).cast("bigint").alias("score"),
        F.when(first, size % 7).cast("bigint").alias("num_comments"),
        F.when(first, (size % 100) / F.lit(100.0)).alias("upvote_ratio"),
        F.when(first, F.concat(F.lit("https://example.org/"), c.cast("string"))).alias("url"),
        F.concat(F.lit("/r/"), c.cast("string")).alias("permalink"),
        F.lit("en").alias("lang"),
        country_of(c).alias("geo_country"),
        at.alias("collected_at"),
    )


KEYWORD_TYPES = ("brand", "category", "brand_category", "category_brand")


def trends_feed(spark: SparkSession, folder: str) -> DataFrame:
    """One point per line item: part brand as keyword, quantity as interest."""
    items, parts, suppliers = (table(spark, folder, n) for n in ("lineitem", "part", "supplier"))
    kind = F.element_at(F.array(*[F.lit(k) for k in KEYWORD_TYPES]), (F.col("l_linenumber") % 4 + 1).cast("int"))
    area = F.element_at(
        F.array(*[F.lit(g) for g in ("US", "US-NY", "US-CA", "CA")]), (F.col("l_suppkey") % 4 + 1).cast("int")
    )
    at = iso(day_of(F.datediff("l_shipdate", F.lit("1995-01-01"))))
    return (
        items.join(parts, items["l_partkey"] == parts["p_partkey"])
        .join(suppliers, items["l_suppkey"] == suppliers["s_suppkey"])
        .select(
            brand_of(F.col("s_nationkey")).alias("brand_id"),
            F.col("p_brand").alias("keyword"),
            kind.alias("keyword_type"),
            area.alias("geo"),
            at.alias("ts_event"),
            (F.col("l_quantity") * 2).cast("bigint").alias("value"),
            F.lit(None).cast("string").alias("category"),
            (kind != "category").alias("is_brand_keyword"),
            F.lit(None).cast("array<string>").alias("related_queries_top"),
            at.alias("collected_at"),
        )
    )


PRODUCTS = {
    "BUILDING": "Mortgage",
    "MACHINERY": "Credit card or prepaid card",
    "AUTOMOBILE": "Vehicle loan",
    "HOUSEHOLD": "Checking or savings account",
}
PRODUCT_ELSE = "Debt collection"
SEVERITIES = {"1-URGENT": 0.9, "2-HIGH": 0.7, "3-MEDIUM": 0.5, "4-NOT SPECIFIED": 0.3}
SEVERITY_ELSE = 0.1


def _cases(column: str, values: dict, other) -> Column:
    expr = F.lit(other)
    for key, value in values.items():
        expr = F.when(F.col(column) == key, F.lit(value)).otherwise(expr)
    return expr


def complaints_feed(spark: SparkSession, folder: str) -> DataFrame:
    """One complaint per order; the document of the same number is the narrative."""
    orders, customers, nations, docs = (
        table(spark, folder, n) for n in ("orders", "customer", "nation", "documents")
    )
    at = iso(day_of(F.col("o_orderkey")))
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return (
        orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
        .join(nations, customers["c_nationkey"] == nations["n_nationkey"])
        .join(docs, orders["o_orderkey"] == docs["doc_id"], "left")
        .select(
            brand_of(F.col("c_nationkey")).alias("brand_id"),
            F.col("o_orderkey").cast("string").alias("complaint_id"),
            at.alias("ts_event"),
            _cases("c_mktsegment", PRODUCTS, PRODUCT_ELSE).alias("product"),
            F.lit(None).cast("string").alias("sub_product"),
            priority.alias("issue"),
            F.col("lang").alias("sub_issue"),
            F.col("text").alias("consumer_complaint_narrative"),
            F.lit("Closed").alias("company_response_to_consumer"),
            F.when(priority != "4-NOT SPECIFIED", status == "F").alias("timely_response"),
            (status == "P").alias("consumer_disputed"),
            F.lit("Web").alias("submitted_via"),
            F.when(status != "O", at).alias("date_sent_to_company"),
            F.when(F.col("c_acctbal") > 0, "Responded").alias("company_public_response"),
            F.lit(None).cast("string").alias("tags"),
            F.col("n_name").alias("state"),
            (F.col("c_custkey") % 100).cast("string").alias("zip_code"),
            F.when(F.col("c_custkey") % 4 == 0, "CA").otherwise("US").alias("geo_country"),
            _cases("o_orderpriority", SEVERITIES, SEVERITY_ELSE).alias("severity_score"),
            at.alias("collected_at"),
        )
    )


def complaints_export_feed(spark: SparkSession, folder: str) -> DataFrame:
    """One export row per order; the document of the same number is the narrative, else a line about the order.

    Texts join last, so they are shuffled once, by their own key, and never by customer.
    """
    docs, orders, customers, nations = (
        table(spark, folder, n) for n in ("documents", "orders", "customer", "nation")
    )
    number, text = F.col("o_orderkey"), F.lit(None).cast("string")
    received = day_of(number)
    line = F.concat(F.lit("Order of priority "), F.col("o_orderpriority"), F.lit(" with state "), F.col("o_orderstatus"))
    # Every text will be matched against many terms.
    placed = orders.join(customers, orders["o_custkey"] == customers["c_custkey"]).join(
        nations, customers["c_nationkey"] == nations["n_nationkey"]
    )
    return (
        in_tasks(placed, "o_orderkey")
        .join(docs, docs["doc_id"] == F.col("o_orderkey"), "left")
        .select(
            number.cast("string").alias("Complaint_ID"),
            F.coalesce("text", line).alias("Consumer_complaint_narrative"),
            _cases("c_mktsegment", PRODUCTS, PRODUCT_ELSE).alias("Product"),
            text.alias("Sub_product"),
            F.col("o_orderpriority").alias("Issue"),
            F.coalesce("lang", F.lit("en")).alias("Sub_issue"),
            F.concat(F.lit("Company "), F.col("c_nationkey").cast("string")).alias("Company"),
            F.col("n_name").alias("State"),
            (F.col("c_custkey") % 100).cast("string").alias("ZIP_code"),
            F.lit("Closed").alias("Company_response_to_consumer"),
            F.lit("Yes").alias("Timely_response"),
            F.lit("N/A").alias("Consumer_disputed"),
            F.lit("Web").alias("Submitted_via"),
            F.date_format(received, "MM/dd/yy").alias("Date_received"),
            F.when(F.col("o_orderstatus") == "O", "").otherwise(
                F.date_format(F.date_add(received, 2), "MM/dd/yy")
            ).alias("Date_sent_to_company"),
        )
    )


def reddit_events_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation turn as an enriched event with metadata."""
    c, turn, size = F.col("conv_id"), F.col("turn"), F.length("text")
    ts = F.timestamp_add("MINUTE", turn.cast("int"), day_of(c).cast("timestamp"))
    meta = F.to_json(
        F.struct(
            F.concat_ws("_", c.cast("string"), turn.cast("string")).alias("reddit_id"),
            F.when(turn == 0, "post").otherwise("comment").alias("reddit_type"),
            F.concat(F.lit("sub"), (c % 5).cast("string")).alias("subreddit"),
            F.col("role").alias("author"),
            F.when(turn == 0, F.concat(F.lit("Thread "), c.cast("string"))).alias("title"),
            (size % 21 - 5).alias("score"),
            F.when(turn == 0, size % 7).alias("num_comments"),
            F.concat(F.lit("/r/"), c.cast("string")).alias("permalink"),
        )
    )
    return table(spark, folder, "conversations").select(
        F.concat(F.when(turn == 0, "reddit_t3_").otherwise("reddit_t1_"), c.cast("string"), F.lit("_"), turn.cast("string")).alias("event_id"),
        ts.alias("ts_event"),
        F.when(c % 3 != 2, "td_bank").otherwise("jpm").alias("brand_id"),
        F.lit("reddit").alias("source"),
        country_of(c).alias("geo_country"),
        "text",
        F.substring(F.sha2("text", 256), 1, 16).alias("content_hash"),
        meta.alias("metadata"),
        ((size % 21 - 10) / F.lit(10.0)).alias("sentiment"),
        ((size % 10) / F.lit(10.0)).alias("severity"),
        F.array(
            F.concat(F.lit("t"), (c % 4).cast("string")), F.concat(F.lit("u"), (turn % 3).cast("string"))
        ).alias("topics"),
        F.lit("en").alias("language"),
        F.lit(0.6).alias("nlp_confidence"),
        F.lit("lexicon").alias("nlp_model"),
        F.lit("v1.0").alias("nlp_version"),
        ts.alias("nlp_processed_at"),
        F.lit(None).cast("string").alias("nlp_error"),
        ts.alias("_ingested_at"),
        F.lit("run-1").alias("_source_run"),
    )


def event_versions(spark: SparkSession, folder: str) -> DataFrame:
    """All events plus re-ingested copies: errors once, and one event per purchase.

    The copies made for purchases share a single id, so one key holds a large
    share of the rows.
    """
    events = table(spark, folder, "events")
    base = events.select(
        F.concat(F.lit("reddit_t3_"), F.col("event_id").cast("string")).alias("event_id"),
        F.col("ts").alias("ts_event"),
        F.when(F.col("user_id") % 5 != 0, F.col("ts")).alias("nlp_processed_at"),
        F.col("event_id").alias("created_utc"),
        F.col("event_type").alias("text"),
        "value",
    )
    later = F.timestamp_add("HOUR", F.lit(3), F.col("ts"))
    again = events.filter("event_type = 'error'").select(
        F.concat(F.lit("reddit_t3_"), F.col("event_id").cast("string")).alias("event_id"),
        F.col("ts").alias("ts_event"), later.alias("nlp_processed_at"),
        F.col("event_id").alias("created_utc"), F.lit("edited").alias("text"), "value",
    )
    hot = events.filter("event_type = 'purchase'").select(
        F.lit("reddit_t3_0").alias("event_id"), F.col("ts").alias("ts_event"),
        later.alias("nlp_processed_at"), F.col("event_id").alias("created_utc"),
        F.lit("copy").alias("text"), "value",
    )
    return base.unionByName(again).unionByName(hot)


def search_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the document and the vector of the same number, where they exist."""
    docs, vectors, events = (table(spark, folder, n) for n in ("documents", "embeddings", "events"))
    e, size = F.col("event_id"), F.coalesce("n_chars", F.length("event_type"))
    return (
        events.select("event_id", "user_id", "event_type")
        .join(docs, docs["doc_id"] == events["event_id"], "left")
        .join(vectors, e == vectors["vec_id"], "left")
        .select(
            "event_id",
            brand_of(F.col("user_id")).alias("brand_id"),
            F.coalesce("source", F.lit("events")).alias("source"),
            day_of(e).cast("timestamp").alias("ts_event"),
            F.coalesce("text", "event_type").alias("text"),
            F.when(size % 13 != 0, (size % 21 - 10) / F.lit(10.0)).alias("sentiment"),
            ((size % 10) / F.lit(10.0)).alias("severity"),
            F.array(F.coalesce("lang", F.lit("en")), F.concat(F.lit("t"), (size % 4).cast("string"))).alias("topics"),
            F.lit(0.6).alias("nlp_confidence"),
            F.lit("lexicon").alias("nlp_model"),
            country_of(F.col("user_id")).alias("geo_country"),
            F.col("embedding").alias("dense_vec"),
            F.col("label").alias("label"),
        )
    )
