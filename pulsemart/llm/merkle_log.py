"""Merkle manifest of a table, kept as a postorder append log.

The nodes of a binary tree over ordered leaves are logged in the order in which they are complete: a node comes right
after its right child.  So the place of every node follows from its level and number and the number of leaves
(:func:`place`), and a sibling is read from the log without any search.

1. Leaves get their places per group: a range sort, counts per task and group, and prefix sums of the counts.
2. Aligned builders take ``2 ** HEIGHT`` neighbouring leaves each and write the log of their subtree.  Its root is a leaf
   of the next round, whose builders log the levels above, until every group has one root (the subroot).
3. The subroots are the leaves of one more tree of the same kind, over all groups.
4. Proofs go the other way: each builder's log and the proof of its own root give the proofs of its leaves.

No task holds more than one builder's leaves, however large a group is, and the rounds are few: three reach 2 ** 36.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemart.llm.common import stage

#: Levels that one builder logs; it takes two to this power leaves.
HEIGHT = 12
DIGEST = 32
_KEY = ("_present", "_group")  # whether a group has a name, and its name


def node_hash(*digests: bytes) -> bytes:
    """SHA-256 of the digests as lower-case hexadecimal text, one after the other."""
    return hashlib.sha256(b"".join(d.hex().encode() for d in digests)).digest()


def place(level: int, number: int, leaves: int) -> int:
    """Place in the log of node ``number`` of ``level``, in a tree of so many leaves.

    After ``m`` leaves, ``2 m - popcount(m)`` nodes are complete.  A node over whole runs comes as many places after its
    last leaf as it is levels above it.  Nodes at the right edge that miss leaves close the log, level by level.
    """
    end = (number + 1) << level
    if end <= leaves:
        return 2 * (end - 1) - (end - 1).bit_count() + level
    whole = (leaves & -leaves).bit_length() - 1  # the highest level that has no such node
    return 2 * leaves - leaves.bit_count() + level - whole - 1


def height_of(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    return (leaves - 1).bit_length()


def build(leaves: list[bytes], height: int) -> bytes:
    """The log of a subtree of ``height`` levels: digests in the order in which their nodes are complete."""
    out: list[bytes] = []
    open_nodes: list[tuple[int, bytes]] = []  # level and digest of complete nodes without a parent
    for leaf in leaves:
        level, node = 0, leaf
        out.append(node)
        while open_nodes and open_nodes[-1][0] == level and level < height:
            node, level = node_hash(open_nodes.pop()[1], node), level + 1
            out.append(node)
        open_nodes.append((level, node))
    level, node = open_nodes.pop()
    while level < height:  # the right edge
        node = node_hash(open_nodes.pop()[1], node) if open_nodes and open_nodes[-1][0] == level else node_hash(node)
        level += 1
        out.append(node)
    return b"".join(out)


def siblings(log: bytes, number: int, leaves: int, height: int) -> list[tuple[int, bytes | None]]:
    """For each level: which child the node is (0 left, 1 right), and its sibling, if it has one."""
    out: list[tuple[int, bytes | None]] = []
    for level in range(height):
        other = (number >> level) ^ 1
        if other << level < leaves:
            at = place(level, other, leaves) * DIGEST
            out.append((other & 1 ^ 1, log[at:at + DIGEST]))
        else:
            out.append((0, None))
    return out


def packed_path(steps: list[tuple[int, bytes | None]]) -> bytes:
    """Steps of a proof as bytes: ``L`` or ``R`` (what the node is) and the sibling, or ``-``."""
    return b"".join(b"-" if other is None else b"LR"[side:side + 1] + other for side, other in steps)


def unpacked_path(path: bytes) -> Iterator[tuple[int, bytes | None]]:
    at = 0
    while at < len(path):
        if path[at:at + 1] == b"-":
            yield 0, None
            at += 1
        else:
            yield b"LR".index(path[at:at + 1]), path[at + 1:at + 1 + DIGEST]
            at += 1 + DIGEST


def folded(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its proof lead to."""
    node = leaf
    for side, other in unpacked_path(path):
        node = node_hash(node) if other is None else node_hash(other, node) if side else node_hash(node, other)
    return node


def proof_digest(path: bytes) -> bytes:
    """SHA-256 of all siblings of a proof as hexadecimal text, from the leaf up."""
    return node_hash(*(other for _, other in unpacked_path(path) if other is not None))


def _numbered(leaves: DataFrame, order: list[Column]) -> DataFrame:
    """Leaves with ``_number``, their place in their group, and ``_count``, the group's leaves."""
    names = leaves.columns
    key = [F.col(k) for k in _KEY]
    ordered = leaves.repartitionByRange(*(c.asc_nulls_first() for c in [*key, *order])).sortWithinPartitions(
        *(c.asc_nulls_first() for c in [*key, *order])
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, held = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            group = batch.column(names.index("_group"))
            missing = batch.column(names.index("_present"))
            if not batch.num_rows:
                continue
            changed = np.ones(batch.num_rows, bool)
            changed[1:] = np.asarray(pc.or_(
                pc.not_equal(group.slice(1), group.slice(0, len(group) - 1)),
                pc.not_equal(missing.slice(1), missing.slice(0, len(missing) - 1)),
            ).fill_null(True))
            changed[0] = (group[0].as_py(), missing[0].as_py()) != last
            rows = np.arange(batch.num_rows)
            heads = np.maximum.accumulate(np.where(changed, rows, -1))
            at = np.where(heads < 0, rows + held, rows - heads)
            held, last = int(at[-1]) + 1, (group[-1].as_py(), missing[-1].as_py())
            extra = [pa.array(np.full(batch.num_rows, task, np.int32)), pa.array(at.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*names, "_task", "_at"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in leaves.schema)
    placed = stage(ordered.mapInArrow(number, f"{kinds}, _task int, _at long"), "leaves")
    counts = placed.groupBy(*_KEY, "_task").agg(F.count(F.lit(1)).alias("_rows"))
    group = Window.partitionBy(*_KEY)
    before = group.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        *_KEY, "_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"), F.sum("_rows").over(group).alias("_count")
    )
    return placed.join(bases, [*_KEY, "_task"]).select(*names, (F.col("_base") + F.col("_at")).alias("_number"), "_count")


@dataclass(frozen=True)
class Forest:
    """Logs of one tree per group.

    ``levels`` holds a table per round, from the leaves up: ``_present, _group, _block, _leaves, _height, log``, a row for
    each builder.  ``roots`` has each group's ``digest``; ``leaves`` the numbered leaves.
    """

    leaves: DataFrame
    levels: list[DataFrame]
    roots: DataFrame


def _log(nodes: DataFrame) -> DataFrame:
    """One round: builders of ``2 ** HEIGHT`` nodes (``_number``, ``_count``, ``digest``) write their logs."""
    schema = "_present boolean, _group string, _block long, _blocks long, _leaves long, _height int, log binary, digest binary"

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_number")
        digests, count = table["digest"].to_pylist(), table["_count"][0].as_py()
        height = min(HEIGHT, height_of(count))
        log = build(digests, height)
        own = {"_present": table["_present"][0].as_py(), "_group": table["_group"][0].as_py(), "_block": table["_number"][0].as_py() >> HEIGHT,
               "_blocks": -(-count >> HEIGHT), "_leaves": len(digests), "_height": height, "log": log, "digest": log[-DIGEST:]}
        kinds = {"_present": pa.bool_(), "_group": pa.string(), "_height": pa.int32(), "log": pa.binary(), "digest": pa.binary()}
        return pa.table({k: pa.array([v], kinds.get(k, pa.int64())) for k, v in own.items()})

    own = nodes.select(*_KEY, "_number", "_count", "digest").withColumn("_block", F.shiftright("_number", HEIGHT))
    return stage(own.groupBy(*_KEY, "_block").applyInArrow(run, schema), "log")


def grow(leaves: DataFrame, order: list[Column]) -> Forest:
    """Trees over ``leaves`` (``_present, _group, digest`` and what ``order`` reads), one per group."""
    numbered = stage(_numbered(leaves, order), "numbered")
    most = numbered.agg(F.max("_count")).first()[0] or 1
    levels = [_log(numbered)]
    while (most := -(-most >> HEIGHT)) > 1:
        below = levels[-1].where("_blocks > 1")
        levels.append(_log(below.select(*_KEY, F.col("_block").alias("_number"), F.col("_blocks").alias("_count"), "digest")))
    roots = levels[0].where("_blocks = 1").select(*_KEY, "digest")
    for level in levels[1:]:
        roots = roots.unionByName(level.where("_blocks = 1").select(*_KEY, "digest"))
    return Forest(numbered, levels, roots)


def _descend(nodes: DataFrame, logs: DataFrame, above: DataFrame, kept: list[str]) -> DataFrame:
    """Proofs of ``nodes`` (``_number`` and the columns ``kept``) by their builders' logs and the proofs of the builders' roots."""
    proofs = logs.join(above, [*_KEY, "_block"]).select(*_KEY, "_block", "_leaves", "_height", "log", "above")
    kinds = ", ".join(f"`{n}` {nodes.schema[n].dataType.simpleString()}" for n in [*_KEY, "_number", *kept])

    def run(own: pa.Table, builder: pa.Table) -> pa.Table:
        if not own.num_rows or not builder.num_rows:
            return own.slice(0, 0).select([*_KEY, "_number", *kept]).append_column("path", pa.array([], pa.binary()))
        log, above, leaves, height = (builder[c][0].as_py() for c in ("log", "above", "_leaves", "_height"))
        mask = (1 << HEIGHT) - 1
        paths = [packed_path(siblings(log, n & mask, leaves, height)) + above for n in own["_number"].to_pylist()]
        return own.select([*_KEY, "_number", *kept]).append_column("path", pa.array(paths, pa.binary()))

    block = nodes.select(*_KEY, "_number", *kept).withColumn("_block", F.shiftright("_number", HEIGHT))
    keys = [*_KEY, "_block"]
    return block.groupBy(*keys).cogroup(proofs.groupBy(*keys)).applyInArrow(run, f"{kinds}, path binary")


def proofs(forest: Forest, above: DataFrame, kept: list[str]) -> DataFrame:
    """Proofs of all leaves: ``_present, _group, _number, path`` and the columns ``kept``.

    ``above`` has each group's proof of its own root (``_present, _group, above``), which ends all of the group's proofs.
    """
    empty = above.select(*_KEY, "above")
    down: DataFrame | None = None
    for k in range(len(forest.levels) - 1, -1, -1):
        logs = forest.levels[k]
        # a builder that is its group's last has the group's proof above it; others have what the round above found
        ends = logs.where("_blocks = 1").select(*_KEY, "_block").join(empty, list(_KEY))
        inner = ends if down is None else ends.unionByName(
            down.select(*_KEY, F.col("_number").alias("_block"), F.col("path").alias("above"))
        )
        if k:
            below = forest.levels[k - 1].where("_blocks > 1").select(*_KEY, F.col("_block").alias("_number"))
            down = stage(_descend(below, logs, inner, []), "proofs")
        else:
            down = _descend(forest.leaves, logs, inner, kept)
    return down


def field(column: str) -> Column:
    """A value as the leaves take it: ``-`` if missing, else its UTF-8 bytes' number, ``:`` and the value."""
    value = F.col(column).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def manifest(docs: DataFrame) -> DataFrame:
    """Leaves, roots and proofs of all documents, each proof checked against a tampered copy of some rows.

    A leaf is the SHA-256 of ``doc_id, source, lang, n_chars, text``.  Leaves are ordered by ``doc_id`` (missing first)
    per ``lang``; of equal ids, by leaf.  Equal rows have equal leaves and places next to each other.  Where 7 divides
    the CRC-32 of the decimal ``doc_id``, the checked row has ``n_chars`` raised by one; a missing ``n_chars`` or
    ``doc_id`` leaves the row as it is.  An empty or missing text is a leaf like any other, a text of any length is
    hashed as it is, other columns have no effect, and an empty table gives no rows.

    Returns ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.
    """
    leaf = F.sha2(F.concat(*(field(c) for c in FIELDS)), 256)
    raised = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    checked = F.sha2(F.concat(*(field(c) for c in FIELDS[:3]), field("_raised"), field("text")), 256)
    # stored with the leaves, the salt tells equal rows apart and splits a hot id when they are sorted
    leaves = stage(
        docs.select(*FIELDS).withColumn("_raised", raised).select(
            F.col("lang").isNotNull().alias("_present"), F.coalesce("lang", F.lit("")).alias("_group"),
            F.col("doc_id").cast("long").alias("doc_id"), F.unhex(leaf).alias("digest"), F.unhex(checked).alias("checked"),
            F.xxhash64(F.monotonically_increasing_id()).alias("_salt"),
        ),
        "hashed",
    )
    trees = grow(leaves, [F.col("doc_id"), F.col("digest"), F.col("_salt")])
    tops = trees.roots.select(
        F.lit(False).alias("_present"), F.lit("").alias("_group"), F.col("_present").alias("present"), F.col("_group").alias("name"), "digest"
    )
    top = grow(tops, [F.col("present"), F.col("name")])
    nothing = top.roots.select(*_KEY, F.lit(b"").alias("above"))
    above = stage(
        proofs(top, nothing, ["present", "name", "digest"]).join(top.roots.select(*_KEY, F.col("digest").alias("root")), list(_KEY))
        .select(F.col("present").alias("_present"), F.col("name").alias("_group"), F.col("digest").alias("subroot"), F.col("path").alias("above"), "root"),
        "subroots",
    )
    proved = proofs(trees, above, ["doc_id", "digest", "checked"]).join(above.drop("above"), list(_KEY))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in range(1, 4)), strict=True)
            found = [(proof_digest(path).hex(), folded(checked, path)) for path, checked, _ in rows]
            ends = [end for _, end in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(4), batch.column(5), batch.column(6),
                    pa.array([p for p, _ in found], pa.string()), pa.array([e.hex() for e in ends], pa.string()),
                    pa.array([e == r for e, r in zip(ends, batch.column(3).to_pylist(), strict=True)], pa.bool_()),
                ],
                names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
            )

    hexed = [F.lower(F.hex(c)).alias(n) for c, n in (("digest", "leaf"), ("subroot", "subroot"), ("root", "root"))]
    return proved.select("doc_id", "path", "checked", F.col("root").alias("_root"), *hexed).mapInArrow(
        check, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )
