"""Best-fit packing by hierarchical residuals.

Each partition packs its own items best-fit, longest first.  Nearly full bins
are done; the others go on as items of a round with fewer partitions, until
one round holds all that is left.  A round's tasks get a bounded number of
items; bins that no other bin fits stay as they are.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.common import stage, text_of
from pulsemart.llm.tokens import encoder

CAPACITY = 2048
#: A bin with at most so many free places is done.
SLACK = 4
#: Partitions that meet in one of the next round, and the items that a task gets at most.
FAN_IN, TASK_ITEMS = 8, 100_000


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each item (longest first), and what each bin holds.

    Open bins are listed by free space; a bit mask over the free spaces finds the smallest that is large enough.
    """
    bins, offsets, held = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    by_free: dict[int, list[int]] = {}
    mask = 0
    for i in np.argsort(-lengths, kind="stable"):
        length = int(lengths[i])
        fitting = mask >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            k = by_free[free].pop()
            if not by_free[free]:
                mask &= ~(1 << free)
        else:
            free, k = capacity, len(held)
            held.append(0)
        bins[i], offsets[i] = k, capacity - free
        held[k] += length
        if free > length:
            by_free.setdefault(free - length, []).append(k)
            mask |= 1 << (free - length)
    return bins, offsets, held


def _round(items: DataFrame, number: int, capacity: int, final: bool) -> DataFrame:
    """Pack each partition's items (``key``, ``length``, …): adds ``bin``, ``place``, ``held`` and ``done``."""
    names = items.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pa.Table.from_batches(list(batches)).sort_by("key") if (batches := list(batches)) else None
        if own is None or not own.num_rows:
            return
        bins, places, held = best_fit(own["length"].to_numpy(), capacity)
        full = np.array(held)[bins]
        first = (number << 56) | (TaskContext.get().partitionId() << 32)
        out = own.append_column("bin", pa.array(bins + first)).append_column("place", pa.array(places))
        out = out.append_column("held", pa.array(full)).append_column("done", pa.array((full >= capacity - SLACK) | final))
        yield from out.to_batches(max_chunksize=10_000)

    schema = ", ".join(f"{n} {items.schema[n].dataType.simpleString()}" for n in names)
    return items.mapInArrow(run, f"{schema}, bin long, place long, held long, done boolean")


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pack items (``key`` long and unique, ``length`` 1 to ``capacity``): adds ``sequence_id`` and ``offset``.

    Offsets within a sequence are gapless from 0.  An item of ``capacity`` has a sequence of its own.  An empty table
    gives an empty result.
    """
    packed = stage(_round(items, 0, capacity, False), "packed")
    split = packed.select(F.shiftright("bin", 32)).distinct().count()
    out = packed.withColumns({"sequence_id": F.col("bin"), "offset": F.col("place")})
    last, number, before = packed, 1, None
    while True:
        left = last.where("not done and place = 0").select(F.col("bin").alias("key"), F.col("held").alias("length"))
        count = left.count()
        if not count:
            break
        split = max(math.ceil(split / FAN_IN), math.ceil(count / TASK_ITEMS))
        final = split == 1 or (before is not None and count > 0.95 * before)
        last = stage(_round(left.repartition(split, "key"), number, capacity, final), "packed")
        moved = last.select(F.col("key").alias("sequence_id"), F.col("bin").alias("_bin"), F.col("place").alias("_place"))
        out = (
            out.join(moved, "sequence_id", "left")
            .withColumns({"sequence_id": F.coalesce("_bin", "sequence_id"), "offset": F.col("offset") + F.coalesce("_place", F.lit(0))})
            .drop("_bin", "_place")
        )
        if final:
            break
        number, before = number + 1, count
    return out.drop("bin", "place", "held", "done")


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Token pieces of the documents: ``key, doc_id, piece, start, length, ids_crc32``.

    A document's ids end with ``end_id``; only a document of more than ``capacity`` ids is cut.  A missing text is
    empty: one piece with one id.  A missing id stays missing; rows with equal ids are documents of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, key = encoder(tokenizer), TaskContext.get().partitionId() << 36
        for batch in batches:
            for row, ids, starts in coder.slices(batch.column(1)):
                rows = []
                names = batch.column(0).slice(row, len(starts) - 1).to_pylist()
                for name, a, b in zip(names, starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                    own = np.append(ids[a:b], end_id).astype("<u4")
                    for piece, at in enumerate(range(0, len(own), capacity)):
                        part = own[at:at + capacity]
                        rows.append((key, name, piece, at, len(part), zlib.crc32(part.tobytes())))
                        key += 1
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=["key", "doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(
        run, "key long, doc_id long, piece int, start long, length long, ids_crc32 long"
    )
