"""A vector table in lists around coarse centres, searched by probing the nearest lists.

Centres come from k-means over a bounded sample; every row is then stored with its nearest centre, its unit vector and the
same vector in one byte a number.  A search ranks the centres by the asked vector, opens only the folders of the nearest
ones, picks candidates by the bytes, and ranks these again by the exact vectors.  How many lists that takes depends on the data,
so it is measured when the table is written.  With all lists and all rows as candidates the search is exact.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pulsemart.functions.vectors import similarity_to
from pulsemart.sources.layout import by_partition

#: Rows that centres are fitted on at most, rounds of k-means, lists at most, and rows of a list on average.
SAMPLE_ROWS, ROUNDS, MAX_LISTS, LIST_ROWS = 50_000, 12, 4096, 256
#: Candidates ranked exactly.  Opened lists are measured: so many rows are asked for their nearest ones when the table is
#: written, and the fewest lists that give this share of them on average are what a search opens.
CANDIDATES, MEASURED_ROWS, MEASURED_LIMIT, TARGET_RECALL = 1000, 200, 100, 0.93


@dataclass(frozen=True)
class VectorIndex:
    """A written index: its folder, the rows' key, the lists' centres (unit vectors) and the lists that a search opens."""

    path: str
    key: str
    centres: np.ndarray
    probes: int


def unit_rows(vectors: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the usable rows, and which these are: of the right size, finite and not of length zero."""
    lengths = np.asarray(vectors.value_lengths().fill_null(-1)).astype(np.int64)
    rows = np.flatnonzero(lengths == size)
    grid = np.asarray(vectors.take(pa.array(rows)).flatten().fill_null(float("nan")).cast(pa.float64())).reshape(-1, max(1, size))
    sizes = np.linalg.norm(grid, axis=1)
    good = np.isfinite(sizes) & (sizes > 0)
    return grid[good] / sizes[good][:, None], rows[good]


def fit_centres(sample: np.ndarray, lists: int, seed: int = 0) -> np.ndarray:
    """Spherical k-means; a centre without rows moves to the row that is worst served."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)]
    for _ in range(ROUNDS):
        alike = sample @ centres.T
        own = alike.argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        empty = np.flatnonzero(np.bincount(own, minlength=len(centres)) == 0)
        sums[empty] = sample[np.argsort(alike.max(1), kind="stable")[:len(empty)]]
        sizes = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(sizes > 0, sums / np.maximum(sizes, 1e-12), centres)
    return centres


def _codes(grid: np.ndarray) -> np.ndarray:
    """Numbers from -1 to 1 as signed bytes."""
    return np.clip(np.rint(grid * 127), -127, 127).astype(np.int8)


def write_vectors(table: DataFrame, path: str, key: str = "event_id", vector: str = "dense_vec", lists: int | None = None) -> VectorIndex:
    """Index the rows of a table that have a usable vector of the commonest size; keys are unique.

    Centres are fitted on at most ``SAMPLE_ROWS`` rows, chosen by a hash of their key; all rows are stored.
    """
    spark, kind = table.sparkSession, table.schema[key].dataType.simpleString()
    rows = table.filter(F.col(vector).isNotNull()).select(F.col(key).alias("key"), F.transform(vector, lambda x: x.cast("double")).alias("v"))
    sized = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.col("count").desc(), "size").first()
    size, count = (sized["size"], sized["count"]) if sized else (0, 0)
    drawn = rows.filter(F.size("v") == size).orderBy(F.xxhash64("key"), "key").limit(SAMPLE_ROWS).select("v").toArrow()["v"]
    sample, _ = unit_rows(drawn.combine_chunks() if count else pa.array([], pa.list_(pa.float64())), size)
    wanted = lists or min(MAX_LISTS, max(1, -(-count // LIST_ROWS)))
    centres = fit_centres(sample, wanted) if len(sample) else np.zeros((0, size))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grid, own = unit_rows(batch.column(1), size)
            nearest = (grid @ centres.T).argmax(1) if len(grid) else np.zeros(0, np.int64)
            unit = pa.ListArray.from_arrays(pa.array(np.arange(len(grid) + 1) * size, pa.int32()), pa.array(grid.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(own)), unit, pa.array([c.tobytes() for c in _codes(grid)], pa.binary()), pa.array(nearest.astype(np.int32))],
                names=["key", "unit", "code", "list"],
            )

    stored = rows.mapInArrow(assign, f"key {kind}, unit array<double>, code binary, list int")
    by_partition(stored, "list").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("list").parquet(f"{path}/lists")
    heads = [(k, c.tolist()) for k, c in enumerate(centres)]
    spark.createDataFrame(heads, "list int, centre array<double>").coalesce(1).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).parquet(f"{path}/centres")
    asked = rows.withColumnRenamed("key", key).orderBy(F.xxhash64(key), key).limit(MEASURED_ROWS)
    probes = measured_probes(spark, VectorIndex(path, key, centres, len(centres)), asked, "v") if len(centres) else 0
    spark.range(1).select(F.lit(probes).alias("probes")).coalesce(1).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).parquet(f"{path}/probes")
    return open_vectors(spark, path, key)


def measured_probes(spark: SparkSession, index: VectorIndex, queries: DataFrame, vector: str, limit: int = MEASURED_LIMIT) -> int:
    """The fewest lists that hold ``TARGET_RECALL`` of the nearest rows of some queries, on average.

    The queries and their nearest rows come to the driver: ``MEASURED_ROWS`` times ``limit`` rows.
    """
    own = queries.filter(F.col(vector).isNotNull()).select(index.key, F.transform(vector, lambda x: x.cast("double")).alias("v")).toArrow()
    grid, rows = unit_rows(own["v"].combine_chunks() if own.num_rows else pa.array([], pa.list_(pa.float64())), index.centres.shape[1])
    rank = np.argsort(np.argsort(-(grid @ index.centres.T), 1, kind="stable"), 1)
    number = {own[index.key][int(r)].as_py(): k for k, r in enumerate(rows)}
    found = search_many(spark, index, queries, vector, limit, None).select("asked", "list").collect()
    places = np.sort([rank[number[r.asked], r.list] for r in found])
    if not len(places):
        return len(index.centres)
    return int(places[min(len(places) - 1, int(np.ceil(TARGET_RECALL * len(places))) - 1)]) + 1


def open_vectors(spark: SparkSession, path: str, key: str = "event_id") -> VectorIndex:
    found = [r.centre for r in spark.read.parquet(f"{path}/centres").orderBy("list").collect()]  # at most MAX_LISTS rows
    return VectorIndex(path, key, np.array(found, np.float64), spark.read.parquet(f"{path}/probes").first().probes)


def _unit(asked: Sequence[float] | None) -> np.ndarray:
    wanted = np.asarray(asked if asked is not None else [], np.float64)
    length = np.linalg.norm(wanted)
    return wanted / length if length and np.isfinite(length) else wanted[:0]


#: As many lists as were measured when the table was written.
MEASURED = 0


def probed(index: VectorIndex, asked: np.ndarray, probes: int) -> list[int]:
    """Numbers of the lists nearest to a unit vector."""
    order = np.argsort(-(index.centres @ asked), kind="stable")
    return sorted(order[:probes].tolist())


def search(
    spark: SparkSession, index: VectorIndex, query_vector: Column, limit: int = 100, probes: int | None = MEASURED, candidates: int | None = CANDIDATES
) -> DataFrame:
    """``key, similarity`` of the nearest rows by cosine, in the probed lists; equal ones by key.

    ``probes=None, candidates=None`` compares all rows exactly.  A vector that cannot be compared finds nothing.
    """
    asked = _unit(spark.range(1).select(query_vector.alias("v")).first()["v"])
    rows = spark.read.parquet(f"{index.path}/lists") if len(index.centres) else None
    if rows is None or len(asked) != index.centres.shape[1]:
        return spark.createDataFrame([], f"`{index.key}` {'string' if rows is None else rows.schema['key'].dataType.simpleString()}, similarity double")
    if probes is not None:
        rows = rows.filter(F.col("list").isin(probed(index, asked, probes or index.probes)))
    if candidates is not None:
        rough = rows.select("key", "list", _closeness(asked)(F.col("code")).alias("rough"))
        best = rough.orderBy(F.col("rough").desc(), "key").limit(candidates).select("key", "list")
        # at most `candidates` rows; the exact vectors are read from the probed lists only
        rows = rows.join(F.broadcast(best), ["key", "list"], "left_semi")
    exact = rows.select(F.col("key").alias(index.key), similarity_to(asked.tolist())(F.col("unit")).alias("similarity"))
    return exact.orderBy(F.col("similarity").desc(), index.key).limit(limit)


def _closeness(asked: np.ndarray):
    wanted = _codes(asked[None])[0].astype(np.float32)

    @F.arrow_udf("float")
    def close(codes: pa.Array) -> pa.Array:
        grid = np.frombuffer(b"".join(codes.to_pylist()), np.int8).reshape(len(codes), len(wanted))
        return pa.array(grid.astype(np.float32) @ wanted, pa.float32())

    return close


#: Rows and queries that meet in one group at most, on average.
GROUP_ROWS, GROUP_QUERIES = 4096, 512


def search_many(
    spark: SparkSession, index: VectorIndex, queries: DataFrame, vector: str, limit: int = 100, probes: int | None = MEASURED
) -> DataFrame:
    """Nearest rows of many vectors at once: ``asked, key, list, similarity``; ``asked`` is the query's own key.

    Each query meets the rows of its probed lists; a large list, or one that very many queries probe, is cut into groups
    of bounded size.  ``probes=None`` compares with all rows.
    """
    kind, size = queries.schema[index.key].dataType.simpleString(), index.centres.shape[-1]
    rows = spark.read.parquet(f"{index.path}/lists").select("key", "unit", "list")
    row_kind = rows.schema["key"].dataType.simpleString()
    centres = index.centres
    opened = None if probes is None else probes or index.probes

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grid, own = unit_rows(batch.column(1), size)
            near = np.argsort(-(grid @ centres.T), 1, kind="stable")[:, :opened]
            row = np.repeat(np.arange(len(grid)), near.shape[1])
            unit = pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1) * size, pa.int32()), pa.array(grid[row].ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(own[row])), unit, pa.array(near.ravel().astype(np.int32))], names=["asked", "wanted", "list"]
            )

    doubles = queries.filter(F.col(vector).isNotNull()).select(index.key, F.transform(vector, lambda x: x.cast("double")).alias("v"))
    asked = doubles.mapInArrow(probe, f"asked {kind}, wanted array<double>, list int")
    sizes = (
        rows.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS).alias("cuts"))
        .join(asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / GROUP_QUERIES).alias("parts")), "list")
    )  # a row per list, at most MAX_LISTS
    places = F.broadcast(sizes)
    dealt = rows.join(places, "list").withColumn("cut", F.pmod(F.xxhash64("key"), "cuts")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    )
    spread = asked.join(places, "list").withColumn("part", F.pmod(F.xxhash64("asked"), "parts")).withColumn(
        "cut", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))
    )

    def best(stored: pa.Table, wanted: pa.Table) -> pa.Table:
        alike = _grid(wanted["wanted"], size) @ _grid(stored["unit"], size).T
        if alike.shape[1] > limit:
            least = np.partition(alike, -limit, 1)[:, -limit]
            query, row = np.nonzero(alike >= least[:, None])
        else:
            query, row = (x.ravel() for x in np.indices(alike.shape))
        return pa.table({"asked": wanted["asked"].take(pa.array(query)), "key": stored["key"].take(pa.array(row)),
                         "list": stored["list"].take(pa.array(row)), "similarity": alike[query, row]})

    keys = ["list", "cut", "part"]
    met = dealt.select(*keys, "key", "unit").groupBy(*keys).cogroup(spread.select(*keys, "asked", "wanted").groupBy(*keys)).applyInArrow(
        best, f"asked {kind}, key {row_kind}, list int, similarity double"
    )
    order = Window.partitionBy("asked").orderBy(F.col("similarity").desc(), "key")
    return met.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= limit).drop("_place")


def _grid(column: pa.ChunkedArray, size: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def recall(spark: SparkSession, index: VectorIndex, queries: DataFrame, vector: str, limit: int = 100, probes: int | None = MEASURED) -> DataFrame:
    """``asked, wanted, found, recall``: how many of each query's exact nearest rows the probed lists give."""
    exact = search_many(spark, index, queries, vector, limit, None)
    near = search_many(spark, index, queries, vector, limit, probes).select("asked", "key", F.lit(1).alias("hit"))
    return exact.join(near, ["asked", "key"], "left").groupBy("asked").agg(
        F.count(F.lit(1)).alias("wanted"), F.count("hit").alias("found"), (F.count("hit") / F.count(F.lit(1))).alias("recall")
    )
