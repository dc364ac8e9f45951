"""Analysed text for retrieval: words, lower case, stop words, stemming."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, SparkSession, functions as F

from pulsemart.functions.stemmer import porter_stems
from pulsemart.settings import ENGLISH_STOP_WORDS

_WORD = r"[\p{L}\p{N}]+"
# Plural endings of a light English stemmer, applied in order.
_PLURALS = (
    ("(?<=[^ae])ies$", "y"),
    ("(?<=[^aeo])es$", "e"),
    ("(?<=[^us])s$", ""),
)


def stemmed(word: Column) -> Column:
    """A lower-case word without its plural ending; most words have none to test."""
    plain = reduce(lambda c, rule: F.regexp_replace(c, rule[0], rule[1]), _PLURALS, word)
    return F.when(word.endswith("s"), plain).otherwise(word)


def tokens(text: Column, stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS, stem: str | None = "light") -> Column:
    """Words of a text in order; stop words are dropped before stemming.

    ``stem`` is ``light`` (plural endings, native), ``porter`` (the full
    stemmer, Arrow batches) or None.
    """
    if stem not in ("light", "porter", None):
        raise ValueError(f"unknown stemmer {stem!r}")
    words = F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))
    if stop_words:
        words = F.filter(words, lambda w: ~w.isin(list(stop_words)))
    if stem == "porter":
        return porter_stems(words)
    return F.transform(words, stemmed) if stem else words


def query_words(spark: SparkSession, query: str, stop_words=None, stem: str | None = "light") -> list[str]:
    """Distinct analysed words of a query string.

    Evaluated once on a one-row relation, so that plans compare tokens with literals.
    """
    analysed = tokens(F.lit(query), ENGLISH_STOP_WORDS if stop_words is None else stop_words, stem)
    return list(dict.fromkeys(spark.range(1).select(analysed.alias("t")).first().t))
