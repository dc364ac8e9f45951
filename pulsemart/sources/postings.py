"""A postings table for text retrieval: which rows hold a term, in blocks that a query can skip.

Rows of the search table are dealt over ranges by a hash of their key, some ``RANGE_ROWS`` each.  A block holds the rows
of one range that have one term, with how often and how long they are, and the highest score part that any of them gets
from the term.  Blocks lie in folders by a hash of their term, so a query opens only its terms' folders.

The best rows of a query are found in two steps.  The sum of a range's block maxima bounds what its rows can score.  The
ranges with the highest bounds are scored first; their k-th best score is a threshold.  Then only ranges whose bound
reaches the threshold are scored, so no row that can win is left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulsemart.functions.tokens import query_words
from pulsemart.operators.search import inverse_frequency
from pulsemart.settings import DEFAULT_BM25, Bm25
from pulsemart.sources.layout import by_partition

#: Folders by term, and rows of a range (more of them make smaller blocks and closer bounds).
BUCKETS, RANGE_ROWS = 64, 128
#: Tokens that a Python worker counts at a time, besides the last range of a piece.
PIECE_TOKENS = 500_000


@dataclass(frozen=True)
class Postings:
    """A written index: its folder, corpus figures and the settings its block maxima hold for."""

    path: str
    rows: int
    mean: float | None
    ranges: int
    buckets: int
    key: str
    key_type: str
    cfg: Bm25

    def blocks(self, spark: SparkSession) -> DataFrame:
        entry = f"array<struct<key:{self.key_type},tf:int,length:int>>"
        return spark.read.schema(f"term string, range long, docs {entry}, best double, df int, bucket int").parquet(f"{self.path}/blocks")


def _cuts(places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where to cut rows sorted by range: at starts of ranges, some ``PIECE_TOKENS`` tokens apart, and at the end."""
    starts = np.flatnonzero(np.diff(places, prepend=places[0] - 1))
    piece = (np.cumsum(sizes) - sizes)[starts] // PIECE_TOKENS
    return np.append(starts[np.flatnonzero(np.diff(piece, prepend=-1))], len(places))


def _counted(rows: pa.RecordBatch, mean: float, cfg: Bm25) -> pa.RecordBatch:
    """Blocks of whole ranges of ``key, length, range, tokens``."""
    key, length, places, listed = rows.columns
    coded = listed.flatten().dictionary_encode()
    width = len(coded.dictionary)
    row = np.repeat(np.arange(rows.num_rows), listed.value_lengths().to_numpy(zero_copy_only=False))
    pairs, tf = np.unique(row * width + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
    own, term = pairs // width, pairs % width
    numbers, number = np.unique(places.to_numpy(), return_inverse=True)
    block = number[own] * width + term
    order = np.argsort(block, kind="stable")
    own, tf, block = own[order], tf[order], block[order]
    starts = np.flatnonzero(np.diff(block, prepend=-1))
    held = length.take(pa.array(own))
    # as in _part
    part = tf * (cfg.k1 + 1) / (tf + cfg.k1 * (1 - cfg.b + cfg.b * (held.to_numpy(zero_copy_only=False) / mean)))
    ends = pa.array(np.append(starts, len(block)).astype(np.int32))
    listed = [pa.ListArray.from_arrays(ends, values) for values in (key.take(pa.array(own)), pa.array(tf.astype(np.int32)), held)]
    return pa.RecordBatch.from_arrays(
        [coded.dictionary.take(pa.array(block[starts] % width)), pa.array(numbers[block[starts] // width]), *listed, pa.array(np.fmax.reduceat(part, starts))],
        names=["term", "range", "key", "tf", "length", "best"],
    )


def _range_blocks(batches: Iterable[pa.RecordBatch], mean: float, cfg: Bm25) -> Iterator[pa.RecordBatch]:
    """Blocks of rows that come sorted by range, a bounded number of tokens at a time."""
    held: list[pa.RecordBatch] = []
    for batch in chain(batches, [None]):
        if batch is not None:
            if not batch.num_rows:
                continue
            held.append(batch)
            if held[0].column(2)[0] == batch.column(2)[-1]:
                continue  # the range may go on
        if not held:
            return
        rows = pa.concat_batches(held)
        places = rows.column(2).to_numpy()
        # the last range waits for the next batch
        whole = rows.num_rows if batch is None else int(np.searchsorted(places, places[-1]))
        held = [rows.slice(whole)]
        sizes = rows.column(3).value_lengths().to_numpy(zero_copy_only=False)[:whole].astype(np.int64)
        for start, end in pairwise(_cuts(places[:whole], sizes)):
            yield _counted(rows.slice(start, end - start), mean, cfg)


def _part(tf: Column, length: Column, mean: float | None, cfg: Bm25) -> Column:
    """What a term adds to a row's score, before its weight."""
    relative = F.try_divide(length, F.lit(mean))
    return tf * (cfg.k1 + 1) / (tf + cfg.k1 * (1 - cfg.b + cfg.b * relative))


def _folder(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def write_postings(
    table: DataFrame, path: str, key: str = "event_id", cfg: Bm25 = DEFAULT_BM25, buckets: int = BUCKETS, range_rows: int = RANGE_ROWS
) -> Postings:
    """Index a search table (``key``, ``tokens``, ``token_count``); keys are unique and not missing.

    Rows without tokens count in the corpus figures only.  The figures are kept beside the blocks, for ``open_postings``.
    The rows of a range meet in one task, which makes its blocks: no list is collected over a shuffle.
    """
    key_type = table.schema[key].dataType.simpleString()
    figures = table.agg(F.count(F.lit(1)).alias("rows"), F.avg("token_count").alias("mean")).first()
    ranges = max(1, -(-figures.rows // range_rows))
    mean = float("nan") if figures.mean is None else float(figures.mean)
    rows = table.filter(F.size("tokens") > 0).select(
        F.col(key).alias("key"), F.col("token_count").cast("int").alias("length"), F.pmod(F.xxhash64(key), F.lit(ranges)).alias("range"), "tokens"
    )
    blocks = rows.repartition("range").sortWithinPartitions("range").mapInArrow(
        lambda batches: _range_blocks(batches, mean, cfg),
        f"term string, range long, key array<{key_type}>, tf array<int>, length array<int>, best double",
    ).withColumn("df", F.size("key")).withColumn("bucket", _folder(F.col("term"), buckets))
    # flat arrays travel, and become entries where they are written
    by_partition(blocks, "bucket").sortWithinPartitions("bucket", "term", "range").select(
        "term", "range", F.arrays_zip("key", "tf", "length").alias("docs"), "best", "df", "bucket"
    ).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{path}/blocks")
    stats = table.sparkSession.range(1).select(
        F.lit(figures.rows).cast("long").alias("rows"), F.lit(figures.mean).cast("double").alias("mean"), F.lit(ranges).cast("long").alias("ranges"),
        F.lit(buckets).alias("buckets"), F.lit(key).alias("key"),
        F.lit(key_type).alias("key_type"), F.lit(cfg.k1).cast("double").alias("k1"), F.lit(cfg.b).cast("double").alias("b"),
    )
    stats.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/figures")
    return open_postings(table.sparkSession, path)


def open_postings(spark: SparkSession, path: str) -> Postings:
    f = spark.read.parquet(f"{path}/figures").first()
    return Postings(path, f.rows, f.mean, f.ranges, f.buckets, f.key, f.key_type, Bm25(k1=f.k1, b=f.b))


def _blocks(spark: SparkSession, index: Postings, terms: Sequence[str]) -> DataFrame:
    """The blocks of some terms; other terms' folders are not opened."""
    folders = spark.range(1).select(*(_folder(F.lit(t), index.buckets).alias(f"b{i}") for i, t in enumerate(terms))).first()
    return index.blocks(spark).filter(F.col("bucket").isin(sorted(set(folders))) & F.col("term").isin(list(terms)))


def _weights(blocks: DataFrame, index: Postings, terms: Sequence[str]) -> dict[str, float]:
    """Inverse document frequency of each term: one row per term from the block heads."""
    held = blocks.groupBy("term").agg(F.sum("df").cast("double").alias("df"))
    rows = held.select("term", inverse_frequency(F.lit(float(index.rows)), F.col("df")).alias("weight")).collect()
    return {r.term: r.weight for r in rows}


def _scored(blocks: DataFrame, index: Postings, weights: dict[str, float], terms: Sequence[str]) -> DataFrame:
    """Scores of all rows of the blocks, added up in the order of the query's terms."""
    docs = blocks.select("term", F.explode("docs").alias("doc")).select("term", "doc.*")
    part = _part(F.col("tf"), F.col("length"), index.mean, index.cfg)
    sides = docs.groupBy("key").agg(*[F.max(F.when(F.col("term") == t, F.lit(weights.get(t, 0.0)) * part)).alias(f"p{i}") for i, t in enumerate(terms)])
    total = F.lit(0.0)
    for i in range(len(terms)):
        total = total + F.coalesce(f"p{i}", F.lit(0.0))
    return sides.select(F.col("key").alias(index.key), total.alias("score"))


def matching(spark: SparkSession, index: Postings, query: str, stop_words=None, stem: str | None = "light") -> DataFrame:
    """``key, score`` of all rows that hold a term of the query, analysed as the indexed table was."""
    terms = query_words(spark, query, stop_words, stem)
    if not terms:
        return spark.createDataFrame([], f"`{index.key}` {index.key_type}, score double")
    blocks = _blocks(spark, index, terms)
    return _scored(blocks, index, _weights(blocks, index, terms), terms)


def bounds(blocks: DataFrame, weights: dict[str, float]) -> DataFrame:
    """What the rows of each range can score at most, from the block heads alone."""
    weight = F.coalesce(*[F.when(F.col("term") == t, F.lit(w)) for t, w in weights.items()])
    return blocks.groupBy("range").agg(F.sum(weight * F.col("best")).alias("bound"))


def best_matching(
    spark: SparkSession, index: Postings, query: str, limit: int = 5, stop_words=None, stem: str | None = "light"
) -> DataFrame:
    """The ``limit`` best rows of a query, ``key, score``; equal scores by key.

    Blocks of ranges that cannot reach the k-th best score of the first ranges are not scored.
    """
    terms = query_words(spark, query, stop_words, stem)
    order = (F.col("score").desc(), F.col(index.key))
    if not terms:
        return matching(spark, index, query, stop_words, stem)
    blocks = _blocks(spark, index, terms)
    weights = _weights(blocks, index, terms)
    if not weights:
        return matching(spark, index, query, stop_words, stem).limit(0)
    least = threshold(blocks, index, weights, terms, limit)
    able = bounds(blocks, weights).filter(F.col("bound") >= least).select("range")
    return _scored(blocks.join(able, "range", "left_semi"), index, weights, terms).orderBy(*order).limit(limit)


def threshold(blocks: DataFrame, index: Postings, weights: dict[str, float], terms: Sequence[str], limit: int) -> float:
    """A score that ``limit`` rows reach: the lowest of the best rows of the ranges with the highest bounds."""
    first = [r.range for r in bounds(blocks, weights).orderBy(F.col("bound").desc(), "range").limit(2 * limit).collect()]
    found = _scored(blocks.filter(F.col("range").isin(first)), index, weights, terms).orderBy(F.col("score").desc()).limit(limit).collect()
    # a hair lower: sums of parts and of maxima are rounded apart
    return found[-1].score * (1 - 1e-12) if len(found) == limit else 0.0
