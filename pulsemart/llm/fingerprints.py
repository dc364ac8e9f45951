"""Document fingerprints by consistent weighted sampling.

A document is a bag of five-word shingles weighted by their counts.  Each of
the signature's places picks one (shingle, level) pair by Gamma(2, 1) and
uniform numbers drawn from the shingle's hash, so that two documents agree in
a place with the probability of their generalised Jaccard similarity.  The
gamma numbers come from a table of 65,536 quantiles; the hash of the shingle
breaks ties.  A text without words has one term of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.common import text_of
from pulsemart.llm.words import coded_words, mixed, shingles, word_hashes

#: Places of a signature, and quantiles of the gamma table.
SAMPLES, QUANTILES = 64, 1 << 16
#: Terms weighed at once, and text bytes gathered before that.
BLOCK, GROUP_BYTES = 2048, 2_000_000
#: Ranges of ids that a neighbour query uses at most; each is one sorted stream, so their size needs no memory.
MOST_RANGES = 4096


def _gamma_quantiles() -> np.ndarray:
    """Quantiles of Gamma(2, 1), whose distribution function is 1 - (1 + x) exp(-x), by bisection."""
    at = (np.arange(QUANTILES) + 0.5) / QUANTILES
    low, high = np.zeros(QUANTILES), np.full(QUANTILES, 64.0)
    for _ in range(60):
        middle = (low + high) / 2
        below = 1 - (1 + middle) * np.exp(-middle) < at
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return (low + high) / 2


_TABLES: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    if not _TABLES:
        gamma = _gamma_quantiles()
        factors = mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        _TABLES.extend([gamma.astype(np.float32), np.log(gamma).astype(np.float32), factors])
    return _TABLES


def _keys(terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each term and place: the sampling value in the upper half, the (term, level) pair in the lower half."""
    gamma, log_gamma, factors = _tables()
    z = terms[:, None] * factors
    z ^= z >> np.uint64(31)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    r = gamma[z >> np.uint64(48)]
    value = log_gamma[(z >> np.uint64(32)) & np.uint64(0xFFFF)]
    beta = ((z >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.float32) * np.float32(1 / QUANTILES)
    pair = np.broadcast_to((terms & np.uint64(0xFFFFFFFF))[:, None], z.shape)
    heavy = np.flatnonzero(weights > 1)
    if len(heavy):  # a weight of 1 has level 0
        level = np.floor(np.log(weights[heavy])[:, None] / r[heavy] + beta[heavy])
        pair = pair.copy()
        pair[heavy] = (pair[heavy] + level.astype(np.uint64) * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)
        beta[heavy] -= level.astype(np.float32)
    value += r * (beta - np.float32(1))  # ln c - r (level - beta + 1)
    value += np.float32(128)  # positive, so that the bits are in order
    return (value.view(np.uint32).astype(np.uint64) << np.uint64(32)) | pair


def _least(bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Least key of each bag of (terms, weights) and place; an empty bag has the largest key."""
    out = np.full((len(bags), SAMPLES), np.iinfo(np.uint64).max, np.uint64)
    sizes = np.array([len(t) for t, _ in bags], np.int64)
    if not sizes.sum():
        return out
    terms, weights = np.concatenate([t for t, _ in bags]), np.concatenate([w for _, w in bags])
    owner = np.repeat(np.arange(len(bags)), sizes)
    for first in range(0, len(terms), BLOCK):
        part = owner[first:first + BLOCK]
        heads = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        least = np.minimum.reduceat(_keys(terms[first:first + BLOCK], weights[first:first + BLOCK]), heads, axis=0)
        out[part[heads]] = np.minimum(out[part[heads]], least)
    return out


def bags_of(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct shingles, sorted, and their counts, of each text."""
    words, numbers, starts = coded_words(pa.array(texts, pa.large_string()))
    found, ends = shingles(word_hashes(words)[numbers], starts)
    bags = []
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        terms, counts = np.unique(found[a:b], return_counts=True)
        bags.append((terms, counts) if len(terms) else (np.zeros(1, np.uint64), np.ones(1, np.int64)))
    return bags


def signatures(texts: list[str]) -> np.ndarray:
    """Signatures of texts: 16 bits for each place."""
    return (_least(bags_of(texts)) & np.uint64(0xFFFF)).astype(np.uint16)


def _edited(bags: list, edits: list, owners: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of bags, and of edited ones; what an edited bag shares with its owner is weighed once."""
    shared, rest, only = [], list(bags), []
    for (terms, counts), owner in zip(edits, owners, strict=True):
        own, own_counts = bags[owner]
        at = np.minimum(np.searchsorted(own, terms), len(own) - 1)
        same = (own[at] == terms) & (own_counts[at] == counts)
        shared.append((terms[same], counts[same]))
        only.append((terms[~same], counts[~same]))
        left = np.ones(len(own), bool)
        left[at[same]] = False
        rest[owner] = (own[left], own_counts[left])
    both, whole, extra = _least(shared), _least(rest), _least(only)
    whole[owners] = np.minimum(whole[owners], both)
    return ((x & np.uint64(0xFFFF)).astype(np.uint16) for x in (whole, np.minimum(extra, both)))


def written(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def edit(text: str, following: str) -> str:
    """The text, its last quarter replaced by as much of the beginning of the following one."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def _range_of(value: Column, bounds: list[float], low: int = 0) -> Column:
    """Number of bounds at or below the value, as a tree of comparisons."""
    if not bounds:
        return F.lit(low)
    middle = len(bounds) // 2
    return F.when(value >= bounds[middle], _range_of(value, bounds[middle + 1:], low + middle + 1)).otherwise(_range_of(value, bounds[:middle], low))


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of documents and of their edited texts, and likeness to these and to the next document.

    The next document is the one with the next id (equal ids by a hash of the text, missing ids first), after the last
    the first; a single document follows itself.  A missing text is empty; an empty table gives an empty result.
    Documents are dealt by ranges of ids, each with a copy of the first document of the next range.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    count = min(MOST_RANGES, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = sorted(set(base.approxQuantile("doc_id", [k / count for k in range(1, count)], 0.1 / count)))
    placed = base.withColumn("_range", F.when(F.col("doc_id").isNull(), -1).otherwise(_range_of(F.col("doc_id"), bounds)))
    first = sorted((r[0], r[1]) for r in placed.groupBy("_range").agg(F.min("doc_id")).collect())  # a row per range
    before = spark.createDataFrame(
        [(r, i, first[k - 1][0]) for k, (r, i) in enumerate(first)], "first_range int, first_id long, earlier int"
    )
    opening = placed.join(
        F.broadcast(before), (F.col("_range") == F.col("first_range")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    ).select("doc_id", "text", F.col("earlier").alias("_range"), F.lit(True).alias("_next"))
    ordered = (
        placed.withColumn("_next", F.lit(False)).unionByName(opening).repartition("_range")
        .sortWithinPartitions("_range", "_next", "doc_id", F.xxhash64("text"))
    )
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and rows[-1][3] and row[2] == rows[-1][2]:
                    continue  # equal ids open the next range: only the first follows
                rows.append(row)
                held += len(row[1])
                if held > GROUP_BYTES:
                    yield _neighbours(rows)
                    rows, held = rows[-1:], len(row[1])
        if len(rows) > 1:
            yield _neighbours(rows)

    return ordered.select("doc_id", "text", "_range", "_next").mapInArrow(run, schema)


def _neighbours(rows: list[tuple]) -> pa.RecordBatch:
    owners = [i for i in range(len(rows) - 1) if rows[i][2] == rows[i + 1][2] and not rows[i][3]]
    texts = [r[1] for r in rows]
    edits = [edit(texts[i], texts[i + 1]) for i in owners]
    bags = bags_of(texts + edits)
    own, edited = _edited(bags[:len(texts)], bags[len(texts):], owners)
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    out = [
        (rows[i][0], len(texts[i]), hashlib.sha256(e.encode("utf-8", "replace")).hexdigest(), written(own[i]), written(s),
         float((own[i] == s).mean()), float((own[i] == own[i + 1]).mean()))
        for i, e, s in zip(owners, edits, edited, strict=True)
    ]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    columns = list(zip(*out, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
