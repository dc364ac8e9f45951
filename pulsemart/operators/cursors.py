"""Ingest state: latest cursor, cut-off with overlap, cursor advance, run report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pulsemart.settings import IngestWindow


def latest_state(state: DataFrame) -> DataFrame:
    """Newest cursor and tie-breaker of every source (the table is append-only)."""
    newest = F.max(F.struct("updated_at", "cursor_iso", "tie_breaker_id"))
    return state.groupBy("source").agg(newest.alias("s")).select(
        "source", "s.cursor_iso", "s.tie_breaker_id", "s.updated_at"
    )


def fetch_cutoff(
    explicit_since: Column,
    cursor_iso: Column,
    now: Column,
    window: IngestWindow = IngestWindow(),
    initial: Column | None = None,
) -> Column:
    """Seconds since the epoch from which records are read again.

    An explicit start and a stored cursor both step back by the overlap; a
    first run goes back the initial number of days.  An initial fetch ignores
    both and goes back as a first run does.
    """
    overlap = F.lit(window.overlap_seconds)
    asked = F.nullif(explicit_since.cast("bigint"), F.lit(0).cast("bigint"))
    first = F.unix_timestamp(now) - window.initial_days * 86400
    usual = F.coalesce(
        F.when(asked.isNotNull(), F.greatest(asked - overlap, F.lit(0).cast("bigint"))),
        F.unix_timestamp(F.try_to_timestamp(cursor_iso)) - overlap,
        first,
    )
    return usual if initial is None else F.when(initial, first).otherwise(usual)


def advance_cursor(accepted: DataFrame, state: DataFrame, updated_at: Column) -> DataFrame:
    """State rows to append: the largest (time, id) of each source that moved.

    ``accepted`` has source, ts_event and native_id.  Cursors are kept in whole
    seconds, so times are compared in whole seconds; at an equal time a larger
    id moves the cursor on.  Ids compare as text, as the cursor stores them.
    """
    at = F.struct(F.date_trunc("second", "ts_event").alias("at"), F.col("native_id").cast("string").alias("id"))
    reached = accepted.groupBy("source").agg(F.max(at).alias("m"))
    before = latest_state(state).select(
        "source",
        F.struct(
            F.try_to_timestamp("cursor_iso").alias("at"), F.coalesce("tie_breaker_id", F.lit("")).alias("id")
        ).alias("_before"),
    )
    return (
        reached.join(before, "source", "left")
        .filter(F.col("_before.at").isNull() | (F.col("m") > F.col("_before")))
        .select(
            "source",
            F.date_format("m.at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("cursor_iso"),
            F.col("m.id").alias("tie_breaker_id"),
            updated_at.alias("updated_at"),
        )
    )


def run_report(events: DataFrame) -> DataFrame:
    """Totals of one run: records, day files and brands found."""
    per_brand = events.groupBy("brand_id", F.to_date("ts_event").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_brand.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.count_distinct("day").alias("files_saved"),
        F.array_sort(F.collect_set("brand_id")).alias("brands_found"),
    )
