"""A training corpus from raw documents: quality rules, near-duplicate join, personal data, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsemart.llm import mixing, ngram_join, packing, personal, quality
from pulsemart.llm.common import prepare, stage, table, unwrapped, wrapped
from pulsemart.llm.queries import vocabulary


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    prepare(spark)
    return ngram_join.keep_one(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    prepare(spark)
    return personal.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole copies of documents as the curriculum takes them, in training order."""
    prepare(spark)
    return unwrapped(mixing.in_training_order(mixing.mix(wrapped(docs), cut=False)), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of at most 2048 tokens."""
    prepare(spark)
    items = stage(packing.pieces(docs, vocabulary("word_bpe_49k.json"), 0), "pieces")
    return packing.pack(items).drop("key")


STAGES = [
    ("quality_rules", keep_good),
    ("ngram_jaccard_join", keep_one_of_each),
    ("personal_data", without_personal_data),
    ("source_mixing", mixed),
    ("best_fit_packing", packed),
]
#: No stage but mixing can be said in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents; each result is written to the shared folder and read by the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
