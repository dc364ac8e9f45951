"""One row per key: latest version, merge, insert-only, duplicate audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsemart.functions.scores import ratio

#: Newest first; a null sorts last.
EVENT_RECENCY = ("nlp_processed_at", "ts_event", "created_utc")
DUPLICATE_ALERT_PCT = 5.0


def latest_version(df: DataFrame, keys: Sequence[str], newest: Sequence[str | Column]) -> DataFrame:
    """The newest row of each key.

    The rank filter lets Spark keep one candidate per key inside each input
    partition before the shuffle, so a key with very many copies sends only one
    row per task.  Rows that tie on every column of ``newest`` are told apart
    by a hash of the row, which makes the choice repeatable.
    """
    order = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in newest]
    row = F.xxhash64(*[_hashable(df, c) for c in df.columns])
    w = Window.partitionBy(*keys).orderBy(*order, row)
    return df.withColumn("_row", F.row_number().over(w)).filter("_row = 1").drop("_row")


def _hashable(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType.typeName()
    return F.to_json(F.struct(F.col(name))) if kind in ("map", "variant") else F.col(name)


def merged_versions(
    stored: DataFrame, updates: DataFrame, keys: Sequence[str], newest: Sequence[str | Column]
) -> DataFrame:
    """Stored and incoming rows, one per key; on equal ``newest`` columns the stored row stays.

    Only stored rows whose key is updated are ranked; the others pass through a
    filter by key, which costs no shuffle when the updates can be broadcast.
    """
    incoming = updates.select(*keys)
    rivals = stored.join(incoming, list(keys), "left_semi").withColumn("_stored", F.lit(1)).unionByName(
        updates.withColumn("_stored", F.lit(0)), allowMissingColumns=True
    )
    latest = latest_version(rivals, keys, [*newest, "_stored"]).drop("_stored")
    return stored.join(incoming, list(keys), "left_anti").unionByName(latest, allowMissingColumns=True)


def merge_latest(target: DataFrame, updates: DataFrame, keys: Sequence[str], changed: Column) -> DataFrame:
    """Result of an idempotent merge: insert new keys, update when newer.

    ``changed`` is the version stamp, e.g. ``coalesce(edited, ts_event)``.  On
    equal stamps the stored row stays.
    """
    return merged_versions(target, updates, keys, [changed])


def only_new(incoming: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not stored yet."""
    return incoming.join(target.select(*keys), list(keys), "left_anti")


def duplicate_audit(original: DataFrame, cleaned: DataFrame, key: str) -> DataFrame:
    """Row, key and duplicate counts before and after cleaning."""
    return (
        _key_counts(original, key, "Original")
        .unionByName(_key_counts(cleaned, key, "Deduplicated"))
        .orderBy("table_name")
    )


def _key_counts(df: DataFrame, key: str, name: str) -> DataFrame:
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(key).alias("unique_events"),
    ).select(
        F.lit(name).alias("table_name"),
        "total_rows",
        "unique_events",
        (F.col("total_rows") - F.col("unique_events")).alias("duplicate_count"),
    )


def duplicate_rate(df: DataFrame, key: str, alert_pct: float = DUPLICATE_ALERT_PCT) -> DataFrame:
    """Duplicate percentage and whether it calls for an alert."""
    pct = F.round(ratio(F.col("duplicate_count") * 100, F.col("total_rows")), 2)
    return (
        _key_counts(df, key, "table")
        .drop("table_name")
        .withColumn("duplicate_percentage", pct)
        .withColumn("alert", F.coalesce(F.col("duplicate_percentage") > alert_pct, F.lit(False)))
    )


def most_duplicated(df: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Keys stored more than once, most copies first."""
    rows = (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .orderBy(F.col("copies").desc(), key)
    )
    return rows.limit(limit) if limit else rows
