"""Near-duplicate classes by an n-gram Jaccard join.

Documents by five-word shingles form a sparse 0/1 matrix.  Two documents link
when their rows share at least 80 of 100 parts of their union, so the join is
the product of the matrix with its transpose, of which only entries above a
bound that follows from the two sizes matter.  The product is blocked and never
formed as a whole:

* Columns are dealt over shards.  A column with a single row adds to no
  product; a document with too few shared columns cannot reach the bound with
  any other and leaves (most do).
* Of the rest, a row's rarest columns suffice to find its partners: two rows
  that reach the bound share one of their first n - ceil(0.8 n) + 1 columns in
  order of frequency.
* Entries are accumulated exactly for one hub row per column first.  Rows that
  link with the hub are one class, and pairs inside a class need no entry.  The
  overlaps with the hub bound all others of its column: two rows share at most
  the smaller of their overlaps with the hub, and what each has outside of it
  in columns with other rows.  Rows and pairs that cannot reach the bound leave
  (in a crowd of near copies, all but a few); what is left is accumulated.

Equal shingle sets are one row throughout.  Rows are known by a 64-bit hash of
their set, columns by 46 or more bits of theirs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.common import stage, text_of, unwrapped, wrapped
from pulsemart.llm.words import coded_words, mixed, parts, shingles, word_hashes

#: Documents link when OF x intersection >= PARTS x union.
PARTS, OF = 80, 100
CHUNK_BYTES = 4_000_000
#: Entries per shard of columns and per block of rows, and bytes of a column's number inside its shard.  Most entries leave
#: with their shard, so a shard may be the larger; a row sends its key to each shard that it has columns in.
SHARD_ENTRIES, BLOCK_ENTRIES, COLUMN_BYTES = 2_000_000, 1_000_000, 5


def needed(n: int | np.ndarray) -> int | np.ndarray:
    """Least overlap of a row of n columns with any partner."""
    return -(-n * PARTS // OF)


def _sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts in a row, sorted in each; where each text's start, with the end; each set's hash as a signed number."""
    words, numbers, starts = coded_words(texts)
    found, ends = shingles(word_hashes(words)[numbers], starts)
    places = ends.tolist()
    for a, b in zip(places[:-1], places[1:], strict=True):
        found[a:b].sort()
    new = np.ones(len(found), bool)
    new[1:] = found[1:] != found[:-1]
    new[ends[:-1][np.diff(ends) > 0]] = True
    found, ends = found[new], np.concatenate([[0], np.cumsum(new)])[ends]
    one, two = (
        np.diff(np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(x))])[ends])  # sums, modulo 2 ** 64
        for x in (found + np.uint64(0x5851F42D4C957F2D), found * np.uint64(3))
    )
    return found, ends, mixed((one ^ two) + np.diff(ends).astype(np.uint64)).view(np.int64)


def with_sets(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with ``n_shingles`` and ``set_key`` of each whole text."""
    inner = [f"k{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "t", CHUNK_BYTES):
                _, ends, keys = _sets(part.column("t"))
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in inner] + [pa.array(np.diff(ends), pa.int64()), pa.array(keys, pa.int64())],
                    names=[*inner, "n_shingles", "set_key"],
                )

    source = docs.select(*(F.col(c).alias(i) for c, i in zip(keep, inner, strict=True)), text_of().alias("t"))
    schema = "".join(f"{i} {docs.schema[c].dataType.simpleString()}, " for c, i in zip(keep, inner, strict=True))
    out = source.mapInArrow(run, f"{schema}n_shingles long, set_key long")
    return out.select(*(F.col(i).alias(c) for c, i in zip(keep, inner, strict=True)), "n_shingles", "set_key")


def _low_bytes(values: np.ndarray) -> np.ndarray:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :COLUMN_BYTES]


def _from_low_bytes(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) // COLUMN_BYTES, 8), np.uint8)
    out[:, :COLUMN_BYTES] = raw.reshape(-1, COLUMN_BYTES)
    return out.view("<u8").ravel()


def _cut(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The bytes of ``values`` from each of ``starts`` to the next one, the last to the end."""
    values = np.ascontiguousarray(values)
    places = (np.append(starts, len(values)) * (values.nbytes // max(1, len(values)))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(values)])


def _flat(values: pa.ChunkedArray, kind: str) -> np.ndarray:
    """The bytes of all values in a row, as numbers."""
    out = []
    for chunk in values.cast(pa.large_binary()).chunks:
        if len(chunk):
            _, places, data = chunk.buffers()
            places = np.frombuffer(places, np.int64)[chunk.offset:chunk.offset + len(chunk) + 1]
            out.append(np.frombuffer(data, np.uint8)[places[0]:places[-1]])
    return np.concatenate(out).view(kind)


def _messages(to: str, target: np.ndarray, owner: np.ndarray, keys: np.ndarray, sizes: np.ndarray, columns: np.ndarray, **more: np.ndarray) -> pa.RecordBatch:
    """Entries sorted by target and owner (a place in ``keys`` and ``sizes``), one row per target.

    No step is taken per row: there is one for each pair of sender and target.
    """
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (target[1:] != target[:-1])
    first = np.flatnonzero(new)
    head = np.ones(len(first), bool)
    head[1:] = target[first[1:]] != target[first[:-1]]
    starts = np.flatnonzero(head)
    own = owner[first]
    arrays = [
        pa.array(target[first[starts]].astype(np.int32)), _cut(keys[own], starts), _cut(sizes[own].astype("<u4"), starts),
        _cut(np.diff(np.append(first, len(owner))).astype("<u4"), starts), *(_cut(x, first[starts]) for x in (columns, *more.values())),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=[to, "keys", "sizes", "counts", "columns", *more])


def _entries(docs: DataFrame, shards: int) -> DataFrame:
    """The matrix's entries by shard of columns: rows' keys, sizes, entries in this shard, and columns, row by row.

    Equal rows of a chunk of texts are sent once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text", CHUNK_BYTES):
                columns, ends, keys = _sets(part.column(0))
                sizes = np.diff(ends)
                once = np.zeros(len(keys), bool)
                once[np.unique(keys, return_index=True)[1]] = True
                once &= sizes > 0
                columns, keys, sizes = columns[np.repeat(once, sizes)], keys[once], sizes[once]
                if not len(keys):
                    continue
                shard = ((columns >> np.uint64(40)) % np.uint64(shards)).astype(np.uint16 if shards < 1 << 16 else np.int64)
                order = np.argsort(shard, kind="stable")
                owner = np.repeat(np.arange(len(keys)), sizes)[order]
                yield _messages("shard", shard[order], owner, keys, sizes, _low_bytes(columns[order]))

    return docs.select(text_of().alias("text")).mapInArrow(run, "shard int, keys binary, sizes binary, counts binary, columns binary")


def _shared(entries: DataFrame, blocks: int) -> DataFrame:
    """Entries in columns that have at least two rows, with the column's rows counted, dealt by block of rows."""

    def run(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        columns = _from_low_bytes(_flat(table["columns"], "u1"))
        order = np.argsort(columns)
        columns = columns[order]
        same = columns[1:] == columns[:-1]
        twice = np.concatenate([[False], same]) | np.concatenate([same, [False]])  # the others, most, leave before all else
        columns, order = columns[twice], order[twice]
        del same, twice
        keys, sizes, counts = _flat(table["keys"], "<i8"), _flat(table["sizes"], "<u4"), _flat(table["counts"], "<u4")
        row = np.repeat(np.arange(len(keys), dtype=np.int32), counts)[order]
        used = np.zeros(len(keys), bool)
        used[row] = True
        keys, first, which = np.unique(keys[used], return_index=True, return_inverse=True)
        sizes, owner = sizes[used][first], which.astype(np.int32)[(np.cumsum(used, dtype=np.int32) - 1)[row]]
        del row, used, first, which
        order = np.lexsort((owner, columns))
        columns, owner = columns[order], owner[order]
        del order
        new = np.ones(len(columns), bool)
        new[1:] = (columns[1:] != columns[:-1]) | (owner[1:] != owner[:-1])  # equal rows of several chunks
        columns, owner = columns[new], owner[new]
        heads = np.flatnonzero(np.diff(columns, prepend=~columns[:1]))
        frequency = np.diff(np.append(heads, len(columns))).astype("<u4")
        often = np.repeat(frequency, frequency)
        columns, owner, often = columns[often > 1], owner[often > 1], often[often > 1]
        block = (keys.view(np.uint64) % np.uint64(blocks)).astype(np.int32)[owner]
        order = np.lexsort((owner, block))
        columns = columns[order]
        columns |= np.uint64(shard << 40)
        return pa.Table.from_batches([_messages("block", block[order], owner[order], keys, sizes, columns, often=often[order])])

    return entries.groupBy("shard").applyInArrow(
        run, "block int, keys binary, sizes binary, counts binary, columns binary, often binary"
    )


def _candidates(shared: DataFrame) -> DataFrame:
    """Rows that can reach the bound: ``key, n, alone, columns`` (shared ones, sorted) and ``rare``, the deciding columns."""

    def run(table: pa.Table) -> pa.Table:
        keys, counts = _flat(table["keys"], "<i8"), _flat(table["counts"], "<u4")
        sizes, columns, often = _flat(table["sizes"], "<u4"), _flat(table["columns"], "<u8"), _flat(table["often"], "<u4")
        distinct, first, which = np.unique(keys, return_index=True, return_inverse=True)
        owner = np.repeat(which, counts)
        have = np.bincount(owner, minlength=len(distinct))
        n = sizes[first].astype(np.int64)
        able = have >= needed(n)
        order = np.lexsort((columns, often, owner))
        order = order[able[owner[order]]]
        columns, owner = columns[order], owner[order]
        out = []
        ends = np.concatenate([[0], np.cumsum(np.where(able, have, 0))])
        for row in np.flatnonzero(able):
            own = columns[ends[row]:ends[row + 1]]
            rare = own[:len(own) - needed(int(n[row])) + 1]
            out.append((int(distinct[row]), int(n[row]), int(n[row] - len(own)), np.sort(own).tobytes(), rare.astype(np.int64).tolist()))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
        lists = list(zip(*out, strict=True)) or [()] * 5
        return pa.table([pa.array(c, k) for c, k in zip(lists, kinds, strict=True)], names=["key", "n", "alone", "columns", "rare"])

    return shared.groupBy("block").applyInArrow(run, "key long, n long, alone long, columns binary, rare array<long>")


def _overlaps(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Exact overlap of pairs ``(a, b)``: adds ``both`` and ``linked``, and ``strays_a``, ``last_a`` (and ``_b``).

    Strays are a row's deciding columns that its partner lacks; last is the place of the last of them, from 0.
    """
    one, two = (
        rows.select(F.col("key").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("n", "columns", "rare"))) for s in ("a", "b")
    )

    def strays(rare: np.ndarray, columns: np.ndarray) -> tuple[int, int]:
        at = np.flatnonzero(~np.isin(rare, columns))
        return len(at), int(at[-1]) if len(at) else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["both", "linked", "strays_a", "last_a", "strays_b", "last_b"]
        for batch in batches:
            out = []
            for n_a, columns_a, rare_a, n_b, columns_b, rare_b in zip(*(batch.column(k).to_pylist() for k in range(2, 8)), strict=True):
                x, y = np.frombuffer(columns_a, "<i8"), np.frombuffer(columns_b, "<i8")
                both = np.intersect1d(x, y, assume_unique=True).size
                out.append((both, OF * both >= PARTS * (n_a + n_b - both), *strays(np.array(rare_a), y), *strays(np.array(rare_b), x)))
            kinds = [pa.int64(), pa.bool_(), *[pa.int64()] * 4]
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["a", "b", *names]
            )

    return (
        pairs.join(one, "a").join(two, "b")
        .select("a", "b", "n_a", "columns_a", "rare_a", "n_b", "columns_b", "rare_b")
        .mapInArrow(run, "a long, b long, both long, linked boolean, strays_a long, last_a long, strays_b long, last_b long")
    )


def components(links: DataFrame) -> DataFrame:
    """Smallest key reachable by links: ``(key, label)`` for all linked keys, from ``(a, b)``.

    Each key points to its smallest neighbour; pointers are followed to their ends by doubling, links are carried over
    to the ends, and so on until no link is left between different ends.
    """
    edges = stage(links.select("a", "b").where("a != b").distinct(), "edges")
    labels: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = stage(both.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("low")).select("key", F.least("key", "low").alias("label")), "to")
        while True:
            onward = to.select(F.col("key").alias("label"), F.col("label").alias("further"))
            moved = stage(to.join(onward, "label").select("key", F.col("further").alias("label"), (F.col("further") != F.col("label")).alias("moved")), "to")
            to = moved.drop("moved")
            if moved.where("moved").isEmpty():
                break
        if labels is None:
            labels = to
        else:
            step = to.withColumnRenamed("label", "further").withColumnRenamed("key", "label")
            labels = stage(labels.join(step, "label", "left").select("key", F.coalesce("further", "label").alias("label")), "labels")
        ends = edges
        for side in ("a", "b"):
            ends = ends.join(to.select(F.col("key").alias(side), F.col("label").alias(f"{side}_")), side).drop(side).withColumnRenamed(f"{side}_", side)
        edges = stage(ends.where("a != b").distinct(), "edges")
    return labels if labels is not None else edges.select(F.col("a").alias("key"), F.col("b").alias("label"))


def classes(docs: DataFrame, total_shingles: int) -> DataFrame:
    """``(key, label)`` of all shingle sets that link with a different one."""
    shards, blocks = (max(64, -(-total_shingles // n)) for n in (SHARD_ENTRIES, BLOCK_ENTRIES))
    rows = stage(_candidates(_shared(_entries(docs, shards), blocks)), "rows")
    columns = stage(rows.select("key", "n", "alone", F.posexplode("rare").alias("place", "column")), "columns")
    # The row with the fewest columns of its own, as a crowd's pattern has.
    best = F.struct((F.col("alone") / F.col("n")).alias("share"), "key", "n")
    hubs = columns.groupBy("column").agg(F.min(best).alias("hub"), F.count("*").alias("height")).where("height > 1")
    placed = stage(
        columns.join(hubs, "column").select("column", "place", "key", "n", "alone", F.col("hub.key").alias("hub"), F.col("hub.n").alias("n_hub")),
        "placed",
    )
    first = placed.where((F.col("key") != F.col("hub")) & _fits("n", "n_hub")).select(*_pair("key", "hub")).distinct()
    overlaps = stage(_overlaps(first, rows), "overlaps")
    links = overlaps.where("linked").select("a", "b")
    found = stage(components(links), "classes")
    left = stage(_overlaps(_open_pairs(placed, overlaps, found), rows), "left")
    more = left.where("linked").select("a", "b")
    return found if more.isEmpty() else stage(components(links.unionByName(more)), "classes")


def _fits(n: str, other: str) -> Column:
    return OF * F.least(n, other) >= PARTS * F.greatest(n, other)


def _pair(one: str, two: str) -> tuple[Column, Column]:
    return F.least(one, two).alias("a"), F.greatest(one, two).alias("b")


def _open_pairs(placed: DataFrame, overlaps: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs of different classes that share a deciding column and may reach the bound, by what the hubs show.

    Two rows share at most the smaller of their overlaps with the column's hub, and columns outside of the hub.  If all
    of a row's columns outside of the hub come before this column in the order of frequency, a pair that needs one of
    them meets there, and is left to that column.  Of each column, only rows outside the hub's class are held against
    the others, so a column costs its height times the number of rows that neither link with its hub nor are ruled out.
    """
    known = overlaps.select("a", "b", "both", "strays_a", "last_a", "strays_b", "last_b")
    label = found.select("key", "label")
    is_hub, own = F.col("key") == F.col("hub"), F.col("key") == F.col("a")
    inside = F.when(is_hub, F.col("n") - F.col("alone")).otherwise(F.coalesce("both", F.least("n", "n_hub")))
    outside = F.col("n") - F.col("alone") - F.when(is_hub | F.col("both").isNotNull(), F.col("inside")).otherwise(0)
    strays, last = (F.when(own, F.col(f"{c}_a")).otherwise(F.col(f"{c}_b")) for c in ("strays", "last"))
    rows = (
        placed.select("*", *_pair("key", "hub")).join(known, ["a", "b"], "left")
        .withColumn("inside", inside).withColumn("outside", outside)
        .withColumn("closed", F.coalesce((strays == F.col("outside")) & (last < F.col("place")), F.lit(False)) | is_hub)
        .select("column", "key", "n", "alone", "hub", "inside", F.when(F.col("closed"), 0).otherwise(F.col("outside")).alias("outside"))
        .join(label, "key", "left").withColumn("label", F.coalesce("label", "key"))
        .join(label.select(F.col("key").alias("hub"), F.col("label").alias("hub_label")), "hub", "left")
        .withColumn("hub_label", F.coalesce("hub_label", "hub"))
    )
    reach = F.ceil((F.col("n") + F.col("n_least")) * PARTS / (OF + PARTS))
    bounds = rows.groupBy("column").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.min("n").alias("n_least"), F.max("outside").alias("outside_most")
    ).where("low != high").drop("low", "high")
    able = F.least(F.col("n") - F.col("alone"), F.col("inside") + F.least("outside", "outside_most")) >= reach
    rows = stage(rows.join(bounds, "column").where(able).select("column", "key", "n", "alone", "label", "hub_label", "inside", "outside"), "able")
    other = rows.select("column", *(F.col(c).alias(f"{c}_other") for c in ("key", "n", "alone", "label", "inside", "outside")))
    need = F.ceil((F.col("n") + F.col("n_other")) * PARTS / (OF + PARTS))
    bound = F.least(
        F.least("inside", "inside_other") + F.least("outside", "outside_other"),
        F.col("n") - F.col("alone"), F.col("n_other") - F.col("alone_other"),
    )
    return (
        rows.where("label != hub_label").join(other, "column")
        .where((F.col("label") != F.col("label_other")) & _fits("n", "n_other") & (bound >= need))
        .select(*_pair("key", "key_other")).distinct()
    )


def join(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Component of each row of ``members`` (``doc_id``, ``n_shingles``, ``set_key``): adds ``label`` and ``component_id``.

    The component is the smallest id among all rows reachable by links.  A text without words is linked with nothing
    and has its own id; a missing text is empty; a missing id is never the smallest, unless all are missing.  Ids may
    be missing or repeated, so components of several texts can have the same id; ``label`` tells them apart.
    """
    total = members.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).head()[0]
    found = classes(docs, total)
    labelled = members.join(found.withColumnRenamed("key", "set_key"), "set_key", "left").withColumn("label", F.coalesce("label", "set_key"))
    smallest = labelled.where("n_shingles > 0").groupBy("label").agg(F.min("doc_id").alias("smallest"))
    return labelled.join(smallest, "label", "left").withColumn(
        "component_id", F.when(F.col("n_shingles") > 0, F.col("smallest")).otherwise(F.col("doc_id"))
    ).drop("smallest")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of all documents."""
    members = stage(with_sets(docs.withColumn("doc_id", F.col("doc_id").cast("long")), ["doc_id"]), "members")
    return join(docs, members).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with one row of each component: that with the smallest id (of equal rows, any).

    A missing id comes last.  Texts without words all stay.
    """
    rows = wrapped(docs)
    members = stage(with_sets(rows, ["doc_id"]), "members")
    joined = stage(join(rows, members), "joined")
    first = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "set_key")
    kept = (
        joined.where("n_shingles > 0").groupBy("label").agg(F.min(first).alias("kept"))
        .select(F.col("kept.doc_id").alias("kept_id"), F.col("kept.set_key").alias("kept_key"))
    )
    described = with_sets(rows, ["row", "doc_id", "text"])
    one = (
        described.where("n_shingles > 0")
        .join(kept, (F.col("set_key") == F.col("kept_key")) & F.col("doc_id").eqNullSafe(F.col("kept_id")))
        .dropDuplicates(["doc_id", "set_key"])
    )
    return unwrapped(one.unionByName(described.where("n_shingles = 0"), allowMissingColumns=True), docs.columns)
