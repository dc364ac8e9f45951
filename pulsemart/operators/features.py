"""Complaints of both sources in one shape, and their text features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pulsemart.functions.scores import label_number
from pulsemart.functions.text import alnum_only, has_word, label_by_cut, sentence_marks, space_pieces
from pulsemart.settings import DEFAULT_FEATURES, SEVERITY_AS_SCORE, SEVERITY_CUTS, FeatureSettings


def unified_complaints(events: DataFrame, exports: DataFrame) -> DataFrame:
    """Social complaints and regulator complaints stacked in one shape."""
    nothing = F.lit(None)
    social = events.filter("is_complaint").select(
        F.col("event_id").alias("complaint_id"),
        F.lit("reddit").alias("source_type"),
        "brand_id",
        F.col("text").alias("complaint_text"),
        F.col("event_date").alias("complaint_date"),
        "sentiment", "severity", "topics",
        F.col("subreddit").alias("source_detail"),
        "author", "score", "text_length", "is_complaint",
        label_by_cut(F.col("severity"), SEVERITY_CUTS, "low").alias("severity_level"),
        "nlp_confidence", "geo_country",
    )
    regulator = exports.select(
        F.col("complaint_id").cast("string").alias("complaint_id"),
        F.lit("cfpb").alias("source_type"),
        "brand_id", "complaint_text", "complaint_date",
        nothing.cast("double").alias("sentiment"),
        label_number(
            F.col("severity_level"),
            {k: v for k, v in SEVERITY_AS_SCORE.items() if k != "low"},
            SEVERITY_AS_SCORE["low"],
        ).alias("severity"),
        F.array("issue", "sub_issue").alias("topics"),
        F.col("product").alias("source_detail"),
        nothing.cast("string").alias("author"),
        nothing.cast("bigint").alias("score"),
        "text_length", "is_complaint", "severity_level",
        nothing.cast("double").alias("nlp_confidence"),
        F.lit("US").alias("geo_country"),
    )
    return social.unionByName(regulator)


def flag_name(feature: str) -> str:
    return f"has_{feature}"


def feature_flags(lowered: Column, cfg: FeatureSettings = DEFAULT_FEATURES) -> dict[str, Column]:
    """One 0/1 column per feature, in the declared order."""
    hits = {name: has_word(lowered, words) for name, words in cfg.words}
    hits |= {name: lowered.rlike(pattern) for name, pattern in cfg.patterns}
    return {flag_name(n): F.coalesce(h, F.lit(False)).cast("int") for n, h in hits.items()}


def text_features(complaints: DataFrame, cfg: FeatureSettings = DEFAULT_FEATURES) -> DataFrame:
    """Cleaned text, feature flags, statistics, feature vector and score."""
    text = F.col("complaint_text")
    flags = [flag_name(n) for n in cfg.names]
    return (
        complaints.select(
            "complaint_id", "source_type", "brand_id", "complaint_text", "complaint_date",
            "severity_level", "topics", "source_detail",
        )
        .withColumn("_low", F.lower(text))
        .withColumns(
            {
                "cleaned_text": alnum_only(F.col("_low")),
                **feature_flags(F.col("_low"), cfg),
                "original_length": F.length(text),
                "word_count": space_pieces(text),
                "sentence_count": sentence_marks(text),
            }
        )
        .drop("_low")
        .withColumns(
            {
                "feature_vector": F.concat_ws(",", *[F.col(f).cast("string") for f in flags]),
                "feature_score": sum((F.col(f) for f in flags[1:]), F.col(flags[0])),
            }
        )
    )
