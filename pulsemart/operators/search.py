"""Retrieval over enriched events: text relevance, filters, vectors, diversity."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsemart.functions.parsing import json_text, json_whole
from pulsemart.functions.plan import computed_once
from pulsemart.functions.text import redact
from pulsemart.functions.tokens import query_words, tokens
from pulsemart.functions.vectors import dot, similarity_to, unit
from pulsemart.session import Staging, stage
from pulsemart.settings import DEFAULT_BM25, ENGLISH_STOP_WORDS, Bm25


def search_extract(events: DataFrame, min_chars: int = 10, limit: int | None = None) -> DataFrame:
    """Events as they are indexed: texts of some length, no null scores.

    With a limit, the newest ones.  Without, the order of a whole table has no
    use and is not worth a sort of all texts.
    """
    topics = F.col("topics")
    if events.schema["topics"].dataType.typeName() == "string":
        topics = F.when(topics != "", F.split(topics, ","))
    meta = F.col("metadata")
    rows = events.filter(F.col("text").isNotNull() & (F.length("text") > min_chars)).select(
        "event_id", "brand_id", "source", "ts_event", "text",
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in ("sentiment", "severity")],
        F.coalesce(topics, F.array().cast("array<string>")).alias("topics"),
        F.coalesce(F.col("nlp_confidence").cast("double"), F.lit(0.0)).alias("nlp_confidence"),
        "nlp_model", "geo_country", "content_hash",
        json_text(meta, "subreddit").alias("subreddit"),
        json_text(meta, "author").alias("author"),
        json_text(meta, "permalink").alias("url"),
        json_whole(meta, "score").alias("score"),
        json_whole(meta, "num_comments").alias("num_comments"),
    )
    newest = rows.orderBy(F.col("ts_event").desc_nulls_last(), "event_id")
    return newest.limit(limit) if limit else rows


def search_table(
    events: DataFrame, text: str = "text", stop_words=None, hide_personal: bool = True, stem: str | None = "light"
) -> DataFrame:
    """Events with analysed tokens and their number.

    A query must be analysed with the same ``stem`` as the table.  Write the result (see ``sources.tables.upsert``) and query the table: the
    tokens are then computed once, as an index would hold them.
    """
    body = redact(F.col(text)) if hide_personal else F.col(text)
    analysed = tokens(body, ENGLISH_STOP_WORDS if stop_words is None else stop_words, stem)
    return events.withColumn("tokens", analysed).withColumn("token_count", F.size("tokens"))


def _occurrences(listed: Column, term: str) -> Column:
    """How often a term occurs in a token list."""
    rest = F.size(F.array_remove(listed, F.lit(term)))
    return F.coalesce(F.size(listed) - rest, F.lit(0))


def relevance(
    table: DataFrame, query: str, cfg: Bm25 = DEFAULT_BM25, stop_words=None, score: str = "score",
    stem: str | None = "light",
) -> DataFrame:
    """Add the BM25 score of ``query``; any term may match, others score zero.

    Term counts are computed inside the row.  The corpus figures (documents,
    mean length, documents per term) are one aggregate, read back as a scalar
    subquery, so texts are neither exploded nor shuffled.
    """
    terms = query_words(table.sparkSession, query, stop_words, stem)
    if not terms:
        return table.withColumn(score, F.lit(0.0))
    counts = [_occurrences(F.col("tokens"), term) for term in terms]
    figures = table.agg(
        F.struct(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.avg("token_count").alias("mean"),
            *[F.count_if(c > 0).cast("double").alias(f"df{i}") for i, c in enumerate(counts)],
        ).alias("figures")
    )
    found = F.struct(*[c.alias(f"tf{i}") for i, c in enumerate(counts)])
    scored = computed_once(table, "_found", found).withColumn("_figures", figures.scalar())
    stats = F.col("_figures")
    norm = cfg.k1 * (1 - cfg.b + cfg.b * F.try_divide(F.col("token_count"), stats["mean"]))
    total = F.lit(0.0)
    for i in range(len(terms)):
        tf = F.col(f"_found.tf{i}")
        part = inverse_frequency(stats["n"], stats[f"df{i}"]) * tf * (cfg.k1 + 1) / (tf + norm)
        total = total + F.when(tf > 0, part).otherwise(0.0)
    return scored.withColumn(score, total).drop("_figures", "_found")


def inverse_frequency(documents: Column, holding: Column) -> Column:
    return F.log1p((documents - holding + 0.5) / (holding + 0.5))


def top_matches(
    table: DataFrame,
    query: str,
    limit: int = 5,
    where: Column | None = None,
    key: str = "event_id",
    cfg: Bm25 = DEFAULT_BM25,
    stop_words=None,
    newest: bool = False,
    stem: str | None = "light",
) -> DataFrame:
    """Best (or newest) matches of a query; ``where`` filters hits, not the corpus figures."""
    hits = relevance(table, query, cfg, stop_words, stem=stem).filter(F.col("score") > 0)
    if where is not None:
        hits = hits.filter(where)
    first = F.col("ts_event" if newest else "score").desc()
    return hits.orderBy(first, key).limit(limit)


def by_range(
    df: DataFrame, column: str, low: float, high: float, limit: int = 5, key: str = "event_id"
) -> DataFrame:
    """Rows with a value in the closed range, lowest first."""
    return df.filter(F.col(column).between(low, high)).orderBy(column, key).limit(limit)


def evidence(
    table: DataFrame,
    query: str,
    brands: Sequence[str],
    since: Column,
    limit: int = 10,
    text_boost: float = 2.0,
    cfg: Bm25 = DEFAULT_BM25,
    stop_words=None,
    key: str = "event_id",
) -> DataFrame:
    """Quotes for a question: most negative, most severe, most relevant first.

    The better of the boosted text score and the topic score counts; a topic
    matches when it equals the whole query.
    """
    scored = relevance(table, query, cfg, stop_words, score="_text_score")
    tagged = F.array_contains("topics", query)
    figures = table.agg(
        F.struct(
            F.count_if(F.size("topics") > 0).cast("double").alias("n"),
            F.count_if(tagged).cast("double").alias("df"),
        ).alias("f")
    )
    with_topics = scored.withColumn("_topics", figures.scalar()).withColumn(
        "_topic_score",
        F.when(tagged, inverse_frequency(F.col("_topics.n"), F.col("_topics.df"))).otherwise(0.0),
    )
    best = F.greatest(F.col("_text_score") * text_boost, F.col("_topic_score"))
    return (
        with_topics.withColumn("score", best)
        .filter((F.col("score") > 0) & F.col("brand_id").isin(list(brands)) & (F.col("ts_event") >= since))
        .orderBy(F.col("sentiment").asc(), F.col("severity").desc(), F.col("score").desc(), key)
        .limit(limit)
        .select(key, "brand_id", "text", "sentiment", "severity", "ts_event", "source", "score")
    )


def facets(df: DataFrame) -> DataFrame:
    """Counts and mean sentiment by source, by brand and overall."""
    return (
        df.groupingSets([[F.col("source")], [F.col("brand_id")], []], F.col("source"), F.col("brand_id"))
        .agg(
            F.grouping_id().alias("level"),
            F.count(F.lit(1)).alias("events"),
            F.avg("sentiment").alias("avg_sentiment"),
        )
        .select(
            F.when(F.col("level") == 1, "source").when(F.col("level") == 2, "brand_id")
            .otherwise("all").alias("facet"),
            F.when(F.col("level") == 1, F.col("source")).when(F.col("level") == 2, F.col("brand_id"))
            .alias("bucket"),
            "events", "avg_sentiment",
        )
    )


def nearest(vectors: DataFrame, query_vector: Column, limit: int = 100, key: str = "event_id",
            vector: str = "dense_vec") -> DataFrame:
    """Exact nearest neighbours by cosine similarity.

    The asked vector is one row: it is read once, brought to unit length, and
    compared with whole batches of vectors.
    """
    asked = vectors.sparkSession.range(1).select(query_vector.alias("v")).head()["v"]
    return (
        vectors.withColumn("similarity", similarity_to(asked)(F.col(vector)))
        .filter(F.col("similarity").isNotNull())
        .orderBy(F.col("similarity").desc(), key)
        .limit(limit)
    )


def hybrid(
    table: DataFrame,
    query: str,
    query_vector: Column,
    where: Column,
    limit: int = 10,
    neighbours: int = 100,
    key: str = "event_id",
    vector: str = "dense_vec",
    cfg: Bm25 = DEFAULT_BM25,
    stop_words=None,
) -> DataFrame:
    """Text and vector hits together; a hit of both adds up its scores.

    The vector score is ``(1 + cosine) / 2`` of the nearest rows that pass the
    filter; rows without a vector can still match by text.
    """
    text_hits = relevance(table, query, cfg, stop_words, score="text_score").filter(where)
    near = (
        nearest(table.filter(where).select(key, vector), query_vector, neighbours, key, vector)
        .select(key, ((F.col("similarity") + 1) / 2).alias("vector_score"))
    )
    # `near` holds at most `neighbours` rows, so the join moves nothing else.
    joined = text_hits.join(F.broadcast(near), key, "left")
    total = F.col("text_score") + F.coalesce("vector_score", F.lit(0.0))
    return (
        joined.withColumn("score", total)
        .filter(F.col("score") > 0)
        .orderBy(F.col("score").desc(), key)
        .limit(limit)
    )


def _greedy_pick(limit: int, relevance_weight: float):
    """Picks of one topic among few rows; ``_place`` orders them by score, then key."""

    def pick(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_place", ignore_index=True)
        units = [np.asarray(v, "float64") for v in rows["_unit"]]
        base = relevance_weight * rows["_score"].to_numpy("float64")
        closest = np.full(len(rows), np.nan)
        left = np.ones(len(rows), bool)
        picked, values = [], []
        while left.any() and len(picked) < limit:
            gain = np.round(base - (1 - relevance_weight) * np.nan_to_num(closest), 9)
            best = int(np.argmax(np.where(left & ~np.isnan(gain), gain, -np.inf)))
            if not left[best]:  # only rows whose score is not a number are left
                best = int(np.argmax(left))
            picked.append(best)
            values.append(-gain[best])
            left &= (rows["_key"] != rows["_key"][best]).to_numpy() & (np.arange(len(rows)) != best)
            near = [u @ units[best] if len(u) == len(units[best]) else np.nan for u in units]
            closest = np.fmax(closest, near)
        return rows.iloc[picked].assign(pick=range(1, len(picked) + 1), _value=values)[
            ["_topic", "pick", "_value", "_score", "_key", "_unit"]
        ]

    return pick


def diverse(
    df: DataFrame,
    topic: str,
    key: str,
    score: str,
    vector: str,
    limit: int = 10,
    relevance_weight: float = 0.7,
    head: int = 1000,
) -> DataFrame:
    """Maximal-marginal-relevance pick per topic, over all rows of the topic.

    Picks are proposed and checked.  A greedy pick among the ``head`` best rows
    of each topic proposes; one scan then follows the proposed picks for every
    other row and finds the first pick that the row beats.  Such rows (the best
    ``head`` of a topic) join the head and their topics pick again, until no row
    beats a pick; each round settles at least one more pick of a topic.  Rows
    whose score cannot reach the last pick are not compared, and no topic is
    ever gathered in one place.

    Values are compared to nine digits; of equal ones the higher score, then
    the smaller key wins.  A key is picked once per topic.  Rows without a
    vector or a score are not candidates; a missing topic is a topic.
    """
    same_topic = F.col("_topic").eqNullSafe(F.col("_of"))
    best_first = Window.partitionBy("_topic").orderBy(F.col("_score").desc(), "_key")
    with Staging(df.sparkSession) as area:
        rows = area.stage(
            df.filter(F.col(vector).isNotNull() & F.col(score).isNotNull()).select(
                F.col(topic).alias("_topic"), F.col(key).alias("_key"), F.col(score).cast("double").alias("_score"),
                unit(F.col(vector)).alias("_unit"), F.monotonically_increasing_id().alias("_row"),
            ),
            "candidates",
        )
        kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
        shape = (
            f"_topic {kinds['_topic']}, pick int, _value double, _score double, _key {kinds['_key']}, _unit array<double>"
        )
        known = area.stage(rows.withColumn("_place", F.row_number().over(best_first)).filter(F.col("_place") <= head).drop("_place"), "head")
        fresh = known
        while True:
            picks = area.stage(
                known.withColumn("_place", F.row_number().over(best_first)).groupBy("_topic")
                .applyInPandas(_greedy_pick(limit, relevance_weight), shape),
                "picks",
            )
            open_picks = picks.join(fresh.select(F.col("_topic").alias("_of")).distinct(), same_topic, "left_semi")
            others = rows.join(known.select("_row"), "_row", "left_anti").select(*rows.columns)
            rivals = _rivals(others, open_picks, limit, relevance_weight)
            best = Window.partitionBy("_topic").orderBy("_step", "_value", F.col("_score").desc(), "_key")
            fresh = area.stage(
                rivals.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= head).select(*rows.columns),
                "rivals",
            )
            if fresh.isEmpty():
                break
            known = known.unionByName(fresh)
        return stage(
            picks.select(F.col("_topic").alias(topic), F.col("_key").alias(key), "pick", F.col("_score").alias(score)), "picks"
        )


def _rivals(rows: DataFrame, picks: DataFrame, limit: int, relevance_weight: float) -> DataFrame:
    """Rows that beat a pick of their topic, with the first such pick and their value there."""
    listed = picks.groupBy(F.col("_topic").alias("_of")).agg(
        F.sort_array(F.collect_list(F.struct("pick", "_value", (-F.col("_score")).alias("_gain"), "_key", "_unit"))).alias("_picks")
    )
    last = F.size("_picks")
    # A cosine is -1 at least; the margin is for rounding.
    reachable = relevance_weight * F.col("_score") + (1 - relevance_weight) + 1e-6 >= -F.array_max(F.transform("_picks", lambda p: p["_value"]))

    def value(closest: Column) -> Column:
        return -F.round(relevance_weight * F.col("_score") - (1 - relevance_weight) * F.coalesce(closest, F.lit(0.0)), 9)

    def state(closest: Column, step: Column, gone: Column) -> Column:
        return F.struct(closest.alias("closest"), step.alias("step"), gone.alias("gone"))

    def follow(s: Column, p: Column) -> Column:
        mine = F.struct(value(s["closest"]).alias("v"), (-F.col("_score")).alias("g"), F.col("_key").alias("k"))
        beats = mine < F.struct(p["_value"].alias("v"), p["_gain"].alias("g"), p["_key"].alias("k"))
        nearer = state(F.greatest(s["closest"], dot(F.col("_unit"), p["_unit"])), s["step"], F.col("_key").eqNullSafe(p["_key"]))
        return F.when(s["gone"] | s["step"].isNotNull(), s).otherwise(
            F.when(beats, state(s["closest"], p["pick"], s["gone"])).otherwise(nearer)
        )

    start = state(F.lit(None).cast("double"), F.lit(None).cast("int"), F.lit(False))
    end = F.col("_end")
    joined = rows.join(listed, F.col("_topic").eqNullSafe(F.col("_of"))).filter((last < limit) | reachable)
    followed = computed_once(joined, "_end", F.aggregate("_picks", start, follow))
    step = F.coalesce(end["step"], F.when((last < limit) & ~end["gone"], last + 1))
    return followed.withColumns({"_step": step, "_value": value(end["closest"])}).filter(F.col("_step").isNotNull()).select(
        *rows.columns, "_step", "_value"
    )


def contributors(
    events: DataFrame, dimension: str, day: str, split_at: str, days: int = 7, limit: int = 10
) -> DataFrame:
    """What moved a metric: volume per value in two adjacent periods, largest change first."""
    date, edge = F.col(day), F.lit(split_at).cast("date")
    now = date.between(edge, F.date_add(edge, days - 1))
    before = date.between(F.date_sub(edge, days), F.date_sub(edge, 1))
    return (
        events.filter(now | before)
        .groupBy(F.col(dimension).alias("value"))
        .agg(
            F.count_if(now).alias("current"),
            F.count_if(before).alias("previous"),
        )
        .withColumn("delta", F.col("current") - F.col("previous"))
        .select(F.lit(dimension).alias("dimension"), "value", "current", "previous", "delta")
        .orderBy(F.abs("delta").desc(), "value")
        .limit(limit)
    )
