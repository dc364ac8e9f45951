"""Token-id files: flat unsigned integers, 64-bit document offsets, read by memory map.

A folder holds, for each shard: ``NNNNN.ids`` (little-endian uint16 if the
vocabulary has at most 65,536 ids, else uint32), ``NNNNN.docs`` (int64 ids,
missing ones first) and ``NNNNN.offsets`` (uint64, counted over all shards,
one more than documents).  Shards follow each other in ascending document id.
A shard's base is the prefix sum of the token counts before it.  Files are
written under a draft name and moved, with the same content on every attempt,
so a task that is run again replaces its own files.
"""

from __future__ import annotations

import json
import os
import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemart.llm.common import files, text_of, write_file
from pulsemart.llm.tokens import encoder


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> None:
    """Write the ids of all documents (``doc_id``, ``text``), each followed by ``end_id``.

    A missing text is empty: its only id is ``end_id``.  Documents with a missing id come first; equal ids are
    ordered by a hash of the text.  An empty table makes a folder without shards.
    """
    spark = docs.sparkSession
    ordered = (
        docs.select("doc_id", text_of().alias("text")).repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, coder = TaskContext.get().partitionId(), encoder(tokenizer)
        kind = "<u2" if max(coder.size, end_id + 1) <= 1 << 16 else "<u4"
        lengths, doc_ids, missing = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0

        def flat() -> Iterator[bytes]:
            nonlocal missing
            for batch in batches:
                missing += batch.column(0).null_count
                doc_ids.append(batch.column(0).fill_null(0).to_numpy().astype(np.int64))
                for _, ids, starts in coder.slices(batch.column(1)):
                    lengths.append(np.diff(starts) + 1)
                    yield np.insert(ids, starts[1:], end_id).astype(kind).tobytes()

        write_file(folder, f"{shard:05d}.ids", flat())
        counts, names = np.concatenate(lengths), np.concatenate(doc_ids)
        if len(counts):
            write_file(folder, f"{shard:05d}.docs", [names.astype("<i8").tobytes()])
            write_file(folder, f"{shard:05d}.lengths", [counts.astype("<u8").tobytes()])
            yield pa.RecordBatch.from_pydict({
                "shard": [shard], "docs": [len(counts)], "missing": [missing], "tokens": [int(counts.sum())], "kind": [kind],
            })

    shards = ordered.mapInArrow(write, "shard long, docs long, missing long, tokens long, kind string").collect()  # a row per task
    manifest, base = [], 0
    for row in sorted(shards):
        manifest.append({**row.asDict(), "base": base})
        base += row.tokens
    fs, path = files(folder)
    fs.create_dir(path, recursive=True)
    write_file(folder, "manifest.json", [json.dumps(manifest).encode()])

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                name = f"{manifest[i]['shard']:05d}"
                with _mapped(folder, f"{name}.lengths", "<u8") as counts:
                    ends = np.concatenate([[0], np.cumsum(counts)]).astype("<u8") + np.uint64(manifest[i]["base"])
                write_file(folder, f"{name}.offsets", [ends.astype("<u8").tobytes()])
            yield batch

    if manifest:
        spark.range(0, len(manifest), 1, len(manifest)).mapInArrow(offsets, "id long").count()


class _mapped:
    """A file as an array: mapped in place, or through a local copy if only a remote store has it."""

    def __init__(self, folder: str, name: str, kind: str) -> None:
        self.fs, path = files(folder)
        self.path, self.kind, self.copy = f"{path}/{name}", kind, None

    def __enter__(self) -> np.ndarray:
        path = self.path
        if not isinstance(self.fs, pyarrow.fs.LocalFileSystem):
            with self.fs.open_input_stream(path) as source, tempfile.NamedTemporaryFile(delete=False) as local:
                while block := source.read(1 << 22):
                    local.write(block)
            path = self.copy = local.name
        return np.memmap(path, self.kind, "r") if os.path.getsize(path) else np.zeros(0, self.kind)

    def __exit__(self, *_: object) -> None:
        if self.copy:
            os.unlink(self.copy)


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """The documents of a folder: ``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids``.

    Each shard is a task; ids are read from the mapped file, document by document.
    """
    fs, path = files(folder)
    with fs.open_input_stream(f"{path}/manifest.json") as source:
        manifest = json.loads(source.read())
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i in (i for batch in batches for i in batch.column(0).to_pylist()):
            entry, name = manifest[i], f"{manifest[i]['shard']:05d}"
            with (
                _mapped(folder, f"{name}.ids", entry["kind"]) as ids, _mapped(folder, f"{name}.offsets", "<u8") as ends,
                _mapped(folder, f"{name}.docs", "<i8") as doc_ids,
            ):
                at = (ends - np.uint64(entry["base"])).astype(np.int64)
                for first in range(0, len(doc_ids), 2_000):
                    rows = range(first, min(first + 2_000, len(doc_ids)))
                    own = [ids[at[r]:at[r + 1]].astype("<u4") for r in rows]
                    columns = {
                        "doc_id": pa.array([None if r < entry["missing"] else int(doc_ids[r]) for r in rows], pa.int64()),
                        "start": pa.array([int(ends[r]) for r in rows], pa.int64()),
                        "n_tokens": pa.array([len(x) for x in own], pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64()),
                    }
                    if with_ids:
                        columns["ids"] = pa.array([x.astype(np.int64) for x in own], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict(columns)

    return spark.range(0, len(manifest), 1, max(1, len(manifest))).mapInArrow(read, schema)
