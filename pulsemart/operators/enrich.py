"""Sentiment, severity and topics of texts.

The built-in scorer is a set of native expressions.  A model may be plugged in
through :func:`score_with`, the one place where rows go to Python.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulsemart.functions.scores import clamp
from pulsemart.functions.text import count_present, scoring_text
from pulsemart.settings import DEFAULT_ENRICH, DateRange, EnrichSettings
from pulsemart.sources.landing import in_days

_NO_TOPICS = "array<string>"
SCORE_FIELDS = "sentiment double, severity double, topics array<string>, language string, confidence double"


def chosen_text(title: Column, body: Column, text: Column) -> Column:
    """Title and body when there is a title, else the text, else the body."""
    titled = F.concat(title, F.lit("\n\n"), F.coalesce(body, F.lit("")))
    return F.when(title != "", titled).otherwise(F.coalesce(text, body, F.lit("")))


def prepared(df: DataFrame, text: Column, cfg: EnrichSettings = DEFAULT_ENRICH) -> DataFrame:
    """Add the cleaned and the lower-cased text as working columns."""
    return df.withColumn("_clean", scoring_text(text)).withColumn("_low", F.lower("_clean"))


def lexicon_scores(cfg: EnrichSettings = DEFAULT_ENRICH) -> dict[str, Column]:
    """Score columns over :func:`prepared` rows; texts that are too short get zeros."""
    lowered = F.col("_low")
    short = F.length("_clean") < cfg.min_chars
    good, bad = count_present(lowered, cfg.positive), count_present(lowered, cfg.negative)
    tone = (
        F.when(good > bad, F.least(F.lit(cfg.limit), good * cfg.sentiment_step))
        .when(bad > good, F.greatest(F.lit(-cfg.limit), bad * -cfg.sentiment_step))
        .otherwise(F.lit(0.0))
    )
    severity = F.least(F.lit(cfg.limit), count_present(lowered, cfg.severe) * cfg.severity_step)
    listed = F.array(
        *[
            F.when(lowered.contains(t.replace("_", " ")) | lowered.contains(t), F.lit(t))
            for t in cfg.topics
        ]
    )
    topics = F.slice(F.filter(listed, lambda t: t.isNotNull()), 1, cfg.max_topics)
    none = F.array().cast(_NO_TOPICS)
    return {
        "sentiment": F.when(short, 0.0).otherwise(tone),
        "severity": F.when(short, 0.0).otherwise(severity),
        "topics": F.when(short, none).otherwise(topics),
        "language": F.lit(cfg.language),
        "nlp_confidence": F.when(short, 0.0).otherwise(F.lit(cfg.confidence)),
    }


def enrich(
    df: DataFrame, processed_at: Column, text: Column | None = None, cfg: EnrichSettings = DEFAULT_ENRICH
) -> DataFrame:
    """Add scores and audit columns by the built-in scorer."""
    source = F.col("text") if text is None else text
    return (
        prepared(df, F.coalesce(source, F.lit("")), cfg)
        .withColumns(
            {
                **lexicon_scores(cfg),
                **_audit(cfg.scorer_name, cfg.scorer_version, processed_at),
                "nlp_error": F.lit(None).cast("string"),
            }
        )
        .drop("_clean", "_low")
    )


def _audit(name: str, version: str, processed_at: Column) -> dict[str, Column]:
    return {
        "nlp_model": F.lit(name),
        "nlp_version": F.lit(version),
        "nlp_processed_at": processed_at,
    }


Scorer = Callable[[pd.Series], pd.DataFrame]


def score_with(
    df: DataFrame,
    scorer: Scorer,
    name: str,
    version: str,
    processed_at: Column,
    text: str = "text",
    cfg: EnrichSettings = DEFAULT_ENRICH,
) -> DataFrame:
    """Add scores by a plugged-in scorer, batch by batch.

    The scorer gets cleaned texts and returns the columns of ``SCORE_FIELDS``.
    Only the text column travels to Python.  A text that raises gets neutral
    scores and the message; a failing batch is halved until only such texts are
    left, so the others keep their scores.
    """
    names = [f.split()[0] for f in SCORE_FIELDS.split(", ")]

    def scored(texts: pd.Series) -> pd.DataFrame:
        try:
            return scorer(texts).reset_index(drop=True)[names].assign(error=None)
        except Exception as problem:  # noqa: BLE001 - any scorer failure is recorded, not raised
            if len(texts) > 1:
                middle = len(texts) // 2
                halves = (texts.iloc[:middle], texts.iloc[middle:])
                return pd.concat([scored(h.reset_index(drop=True)) for h in halves], ignore_index=True)
            neutral = {"sentiment": 0.0, "severity": 0.0, "topics": [[]], "language": cfg.language, "confidence": 0.0}
            return pd.DataFrame({**neutral, "error": [str(problem)]})

    @F.pandas_udf(f"{SCORE_FIELDS}, error string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield scored(texts)

    cleaned = scoring_text(F.coalesce(F.col(text), F.lit("")))
    scores = F.col("_scores")
    return (
        df.withColumn("_scores", run(cleaned))
        .withColumns(
            {
                **{n: scores[n] for n in names if n != "confidence"},
                "nlp_confidence": scores["confidence"],
                **_audit(name, version, processed_at),
                "nlp_model": F.when(scores["error"].isNotNull(), "none").otherwise(F.lit(name)),
                "nlp_error": scores["error"],
            }
        )
        .drop("_scores")
    )


RESPONSE = "struct<sentiment:double,severity:double,topics:array<string>,language:string,confidence:double>"


def parse_response(response: Column, cfg: EnrichSettings = DEFAULT_ENRICH) -> Column:
    """Scores from a model's answer: the outermost braces, clamped, with defaults."""
    inner = F.nullif(F.regexp_extract(response, r"(?s)\{.*\}", 0), F.lit(""))
    # A member that is not a number, or text that is not JSON, voids the answer.
    parsed = F.from_json(inner, RESPONSE, {"mode": "PERMISSIVE"})
    valid = inner.isNotNull() & F.get_json_object(inner, "$").isNotNull()
    none = F.array().cast(_NO_TOPICS)

    def bounded(field: str, low: float, high: float, default: float) -> Column:
        value = F.coalesce(parsed[field], F.lit(default))
        return F.when(valid, clamp(value, low, high)).otherwise(F.lit(0.0)).alias(field)

    topics = F.slice(F.coalesce(parsed["topics"], none), 1, cfg.max_topics)
    return F.struct(
        bounded("sentiment", -1.0, 1.0, 0.0),
        bounded("severity", 0.0, 1.0, 0.0),
        F.when(valid, topics).otherwise(none).alias("topics"),
        F.when(valid, F.coalesce(parsed["language"], F.lit(cfg.language)))
        .otherwise(F.lit(cfg.language)).alias("language"),
        bounded("confidence", 0.0, 1.0, 0.5),
    )


def re_enrich(
    spark: SparkSession,
    path: str,
    days: DateRange,
    processed_at: Column,
    cfg: EnrichSettings = DEFAULT_ENRICH,
) -> None:
    """Recompute the scores of the chosen day folders in place.

    Only the score members of a line change: its other members stay, whatever
    they are.  Lines without text and lines that are not JSON objects are
    written back as they are.
    """
    lines = in_days(spark.read.schema("value string, dt date").text(path), days)
    record = F.from_json("value", "map<string,variant>")
    source = F.nullif(F.get_json_object("value", "$.text"), F.lit(""))
    scores = {**lexicon_scores(cfg), **_audit(cfg.scorer_name, cfg.scorer_version, processed_at)}
    fresh = F.from_json(F.to_json(F.struct(*[c.alias(n) for n, c in scores.items()])), "map<string,variant>")
    kept = F.map_filter(F.col("_record"), lambda name, _: ~name.isin(list(scores)))
    scored = F.to_json(F.map_concat(kept, fresh))
    changed = (
        prepared(lines.withColumn("_record", record), F.coalesce(source, F.lit("")), cfg)
        .withColumn("value", F.when(F.col("_record").isNotNull() & source.isNotNull(), scored).otherwise(F.col("value")))
        .select("value", "dt")
    )
    # The scan ends before the new folders replace the old ones.
    (
        changed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .partitionBy("dt")
        .text(path)
    )
