"""Natural keys and content fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Prefixes of the natural event keys.
POST_PREFIX = "reddit_t3_"
COMMENT_PREFIX = "reddit_t1_"
COMPLAINT_PREFIX = "cfpb_"
FINGERPRINT_CHARS = 16


def social_event_id(kind: Column, native_id: Column) -> Column:
    prefix = (
        F.when(kind == "post", F.lit(POST_PREFIX))
        .when(kind == "comment", F.lit(COMMENT_PREFIX))
        .otherwise(F.concat(F.lit("reddit_"), kind, F.lit("_")))
    )
    return F.concat(prefix, native_id.cast("string"))


def complaint_event_id(native_id: Column) -> Column:
    return F.concat(F.lit(COMPLAINT_PREFIX), F.coalesce(native_id.cast("string"), F.lit("")))


def fingerprint(text: Column) -> Column:
    """First 16 hex digits of SHA-256; a changed value means an edited text."""
    return F.substring(F.sha2(text.cast("string"), 256), 1, FINGERPRINT_CHARS)
