"""Text predicates and statistics as native column expressions.

Arguments named ``lowered`` are columns that already hold lower-cased text.
Callers project ``lower(text)`` into a column of its own first, so it is
computed once per row and not once per term.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from pulsemart.settings import URL_PATTERN

# ASCII word edges.  The JVM's own word boundary follows Unicode letters, which
# would hide a match that touches an accented letter.
_WORD_CHAR = "[0-9A-Za-z_]"
_RIGHT_EDGE = f"(?!{_WORD_CHAR})"


def quote(term: str) -> str:
    """``term`` as a literal inside a regular expression."""
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", term)


def whole_word_pattern(words: Sequence[str]) -> str:
    """Matches any of ``words`` bounded by ASCII word edges."""
    return f"(?:{'|'.join(_starting(quote(w)) for w in words)}){_RIGHT_EDGE}"


def _starting(pattern: str) -> str:
    """``pattern`` where no word character precedes it.

    The check looks back after the match, so most positions fail on the first
    letter instead of on a look-behind.
    """
    return f"{pattern}(?<!{_WORD_CHAR}{pattern})"


def has_word(lowered: Column, words: Sequence[str]) -> Column:
    """True when any of ``words`` occurs as a whole word.

    The plain substring test comes first: it is much cheaper than the pattern
    and settles most texts.
    """
    if not words:
        return F.lit(False)
    return contains_any(lowered, words) & lowered.rlike(whole_word_pattern(words))


def contains_any(lowered: Column, terms: Sequence[str]) -> Column:
    """True when any term occurs as a substring."""
    return reduce(lambda a, b: a | b, [lowered.contains(t) for t in terms], F.lit(False))


def count_present(lowered: Column, terms: Sequence[str]) -> Column:
    """How many of ``terms`` occur at least once as a substring."""
    return reduce(
        lambda a, b: a + b,
        [F.coalesce(lowered.contains(t), F.lit(False)).cast("int") for t in terms],
        F.lit(0),
    )


def label_by_terms(lowered: Column, rules: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """First label whose terms occur in the text."""
    expr = F.lit(default)
    for label, terms in reversed(list(rules)):
        expr = F.when(contains_any(lowered, terms), F.lit(label)).otherwise(expr)
    return expr


def label_by_cut(value: Column, cuts: Sequence[tuple[str, float]], default: str) -> Column:
    """First label whose cut the value exceeds; nulls get the default."""
    expr = F.lit(default)
    for label, cut in reversed(list(cuts)):
        expr = F.when(value > cut, F.lit(label)).otherwise(expr)
    return expr


def tone(lowered: Column, lexicon) -> Column:
    """Positive list first, then negative, else zero."""
    return (
        F.when(has_word(lowered, lexicon.positive), F.lit(lexicon.positive_score))
        .when(has_word(lowered, lexicon.negative), F.lit(lexicon.negative_score))
        .otherwise(F.lit(0.0))
    )


def toxicity(lowered: Column, lexicon) -> Column:
    return F.when(has_word(lowered, lexicon.toxic), F.lit(lexicon.toxic_score)).otherwise(
        F.lit(lexicon.calm_score)
    )


def alnum_only(lowered: Column) -> Column:
    """Lower-cased text reduced to ASCII letters, digits and single spaces.

    Joining the runs that stay is many times faster than replacing the rest:
    the JVM matches a plain class quickly, its negation slowly.
    """
    return F.array_join(F.regexp_extract_all(lowered, F.lit("[a-z0-9]+"), F.lit(0)), " ")


def scoring_text(text: Column) -> Column:
    """The whole text as the enricher reads it: no links, single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, URL_PATTERN, ""), r"\s+", " "))


def strip(text: Column) -> Column:
    """Text without white space at its ends."""
    return F.btrim(text, F.lit(" \t\n\r\f\v"))


def space_pieces(text: Column) -> Column:
    """Pieces between single spaces; empty pieces count."""
    return F.size(F.split(text, " ", -1))


def sentence_marks(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[.!?]"))


# Redaction patterns applied before text is indexed, in order.
EMAIL = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[EMAIL]")
REDACTIONS = (
    (_starting("[0-9]{3}-[0-9]{2}-[0-9]{4}") + _RIGHT_EDGE, "[SSN]"),
    (_starting("[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}") + _RIGHT_EDGE, "[CARD]"),
    (_starting("[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}") + _RIGHT_EDGE, "[PHONE]"),
)


def redact(text: Column) -> Column:
    """Text with personal data masked; the costly address pattern needs an ``@`` to run."""
    masked = F.when(text.contains("@"), F.regexp_replace(text, *EMAIL)).otherwise(text)
    return reduce(lambda c, r: F.regexp_replace(c, r[0], r[1]), REDACTIONS, masked)
