"""Removal of repeated byte strings by a distributed, common-prefix-aware merge sort of suffixes.

A string of ``LENGTH`` bytes that starts twice is found at an anchor: the
smallest hashed 8-byte gram among its first ``WINDOW`` places.  Equal strings
have their anchor at the same place, so only suffixes that start at anchors
are sorted, and each string belongs to exactly one of them.

1. Every text lists hashes of its anchors' next bytes.  Hashes that occur once
   cannot belong to a repeated string; texts without others are done.
2. The anchor suffixes left are sorted into runs, a batch of texts at a time.
   Inside a run, records that agree on both sides of the anchor settle each
   other at once and travel as one.
3. Runs are cut at splitters, front-coded (each suffix without the prefix it
   shares with the one before) and exchanged.
4. A loser tree merges a shard's runs.  It carries each suffix's common prefix
   with the last one put out, and compares bytes only beyond it.
5. Neighbours with long common prefixes are repeated to the right of their
   anchors; among them, common bytes to the left decide which strings repeat.
   Anchors whose next bytes are very frequent take no part in 2 to 5: their
   strings are counted by hashes of both sides, so no task holds such a group.

Texts that are equal as a whole are one text in all this, and are removed if
they have ``LENGTH`` bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.common import stage, text_of
from pulsemart.llm.words import mixed, parts

#: Bytes of a repeated string, places searched for its anchor, and bytes behind an anchor that are always part of it.
LENGTH, WINDOW = 400, 256
SURE = LENGTH - WINDOW
PART_BYTES, RUN_BYTES = 500_000, 6_000_000
#: Regular samples of a run for the choice of splitters, samples that decide per shard, and anchors per shard.
SAMPLES, DECIDING, SHARD_RECORDS = 32, 16, 64_000
#: Anchors with equal next bytes that are merged; more of them are counted.  Distances of a node, counted together first.
HOT_RECORDS, NODE = 2_000, 16
_FACTORS = mixed(np.arange(1, SURE // 8 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def anchors(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, anchor, first and last string start of each anchor, for texts in a row (places count over all)."""
    sizes = np.diff(starts)
    valid = np.maximum(sizes - LENGTH + 1, 0)
    total = int(valid.sum())
    if not total:
        return (np.zeros(0, np.int64),) * 4
    grams = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))
    keys = grams * np.uint64(0x9E3779B97F4A7C15)
    keys ^= keys >> np.uint64(29)
    keys *= np.uint64(0xBF58476D1CE4E5B9)
    keys &= np.uint64(0xFFFFFFFF00000000)
    keys |= np.arange(len(keys), dtype=np.uint64)
    blocks = -(-len(keys) // WINDOW) + 1
    padded = np.full(blocks * WINDOW, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(keys)] = keys
    grid = padded.reshape(blocks, WINDOW)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    text = np.repeat(np.arange(len(sizes)), valid)
    at = np.arange(total) + np.repeat(starts[:-1] - (np.cumsum(valid) - valid), valid)
    least = (np.minimum(behind[at], ahead[at + WINDOW - 1]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    heads = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (text[1:] != text[:-1])]))
    return text[heads], least[heads], at[heads], at[np.append(heads[1:], total) - 1]


def _hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the ``SURE`` bytes from each place."""
    grams = np.ndarray((max(0, len(data) - 7),), "<u8", buffer=data, strides=(1,))
    out = np.zeros(len(at), np.uint64)
    for k in range(SURE // 8):
        out += mixed(grams[at + 8 * k] + _FACTORS[k]) * _FACTORS[k]
    return mixed(out)


def _row(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return np.frombuffer(b"".join(texts) + bytes(8), np.uint8), starts


def _describe(docs: DataFrame) -> DataFrame:
    """``doc_id, sha, n_bytes, hashes`` of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text", PART_BYTES):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                data, starts = _row(texts)
                text, at, _, _ = anchors(data, starts)
                found = _hashes(data, at).view(np.int64)
                cuts = np.searchsorted(text, np.arange(len(texts) + 1))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "sha": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                    "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                    "hashes": pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(found)),
                })

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        run, "doc_id long, sha string, n_bytes long, hashes array<long>"
    )


def _once(docs: DataFrame) -> DataFrame:
    """Each task's different texts: ``sha, text`` (copies leave before they are shuffled)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            shas = [hashlib.sha256(t).digest() for t in texts.to_pylist()]
            new = []
            for k, sha in enumerate(shas):
                if sha not in seen:
                    seen.add(sha)
                    new.append(k)
            yield pa.RecordBatch.from_arrays([pa.array([shas[k].hex() for k in new], pa.string()), texts.take(pa.array(new, pa.int64()))], names=["sha", "text"])

    return docs.select(text_of().alias("text")).where(F.octet_length("text") >= LENGTH).mapInArrow(run, "sha string, text binary")


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    most = min(len(a), len(b))
    while known < most:
        x, y = a[known:known + 32], b[known:known + 32]
        if x != y:
            size = min(len(x), len(y))
            differ = int.from_bytes(x[:size], "big") ^ int.from_bytes(y[:size], "big")
            return known + (size - (differ.bit_length() + 7) // 8)
        known += 32
    return most


def _neighbour_prefixes(strings: list[bytes], width: int) -> np.ndarray:
    """Common prefix of each string with the one before, 0 for the first."""
    out = np.zeros(len(strings), np.int64)
    step = max(2, (4 << 20) // max(1, width))
    for first in range(0, len(strings), step - 1):
        own = strings[first:first + step]
        if len(own) < 2:
            break
        grid = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in own), np.uint8).reshape(len(own), width)
        differ = grid[1:] != grid[:-1]
        same = np.where(differ.any(1), differ.argmax(1), width)
        sizes = np.array([len(s) for s in own])
        out[first + 1:first + len(own)] = np.minimum(same, np.minimum(sizes[1:], sizes[:-1]))
    return out


class LoserTree:
    """Merges sorted runs given as (string, common prefix with the run's string before, record)."""

    def __init__(self, runs: list[Iterator[tuple[bytes, int, tuple]]]) -> None:
        self.runs = [iter(r) for r in runs]
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        self.heads = [next(r, None) for r in self.runs] + [None] * (self.size - len(runs))
        self.known = [0] * self.size  # common prefix of each head with the string put out last
        self.losers = [0] * self.size
        self.winner = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        return self._play(node, self._build(2 * node), self._build(2 * node + 1))

    def _play(self, node: int, a: int, b: int) -> int:
        """The winner goes up; the loser stays, with its common prefix with the winner."""
        x, y = self.heads[a], self.heads[b]
        if y is None or (x is not None and self.known[a] > self.known[b]):
            win, lose = a, b
        elif x is None or self.known[b] > self.known[a]:
            win, lose = b, a
        else:
            same = common_prefix(x[0], y[0], self.known[a])
            first = x[0][same:same + 1] < y[0][same:same + 1] or (x[0][same:same + 1] == y[0][same:same + 1] and a < b)
            win, lose = (a, b) if first else (b, a)
            self.known[lose] = same
        self.losers[node] = lose
        return win

    def __iter__(self) -> Iterator[tuple[bytes, int, tuple]]:
        while (head := self.heads[self.winner]) is not None:
            yield head[0], self.known[self.winner], head[2]
            run = self.winner
            self.heads[run] = following = next(self.runs[run], None)
            self.known[run] = following[1] if following else 0
            node, winner = (run + self.size) // 2, run
            while node:
                winner = self._play(node, winner, self.losers[node]) if node else winner
                node //= 2
            self.winner = winner


def _records(rows: list[tuple[str, bytes, list[int]]]) -> list[tuple]:
    """Sorted (right, left, sha, anchor, least, most) of the texts' anchors whose hashes are listed.

    ``right`` is what follows from the anchor, ``left`` what precedes, backwards, as far as strings of this anchor
    reach; ``least`` and ``most`` are the distances of such strings' starts before the anchor.
    """
    out: list[tuple] = []
    for part in _parts(rows):
        raw, starts, (text, at, first, last) = _wanted(part)
        for t, a, lo, hi in zip(text.tolist(), at.tolist(), first.tolist(), last.tolist(), strict=True):
            out.append((raw[a:min(a + LENGTH, int(starts[t + 1]))], raw[lo:a][::-1], part[t][0], a - int(starts[t]), a - hi, a - lo))
    out.sort()
    return out


def _wanted(part: list[tuple[str, bytes, list[int]]]) -> tuple[bytes, np.ndarray, tuple[np.ndarray, ...]]:
    """The texts in a row, where each starts, and those anchors (text, place, first and last string start) whose hashes are listed."""
    raw = b"".join(r[1] for r in part) + bytes(8)
    starts = np.concatenate([[0], np.cumsum([len(r[1]) for r in part])]).astype(np.int64)
    data = np.frombuffer(raw, np.uint8)
    found = anchors(data, starts)
    wanted = np.unique(np.concatenate([np.asarray(r[2], np.int64) for r in part]))
    keep = np.isin(_hashes(data, found[1]).view(np.int64), wanted)
    return raw, starts, tuple(x[keep] for x in found)


def _parts(rows: list[tuple[str, bytes, list[int]]]) -> Iterator[list[tuple]]:
    """Rows with about ``PART_BYTES`` of text at a time: finding anchors takes some 80 bytes per byte of text."""
    part, held = [], 0
    for row in rows:
        part.append(row)
        held += len(row[1])
        if held >= PART_BYTES:
            yield part
            part, held = [], 0
    if part:
        yield part


def _text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[str, bytes, list[int]]]]:
    """Texts of a run, ``RUN_BYTES`` at a time."""
    rows, held = [], 0
    for batch in batches:
        for k in range(batch.num_rows):
            rows.append(tuple(batch.column(c)[k].as_py() for c in range(3)))
            held += len(rows[-1][1])
            if held >= RUN_BYTES:
                yield rows
                rows, held = [], 0
    if rows:
        yield rows


def _splitters(texts: DataFrame, shards: int) -> list[bytes]:
    """Strings that cut the sorted order into shards of similar size, from regular samples of all runs' anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _text_rows(batches):
            ahead: list[bytes] = []
            for part in _parts(rows):
                raw, _, (_, at, _, _) = _wanted(part)
                ahead += [raw[a:a + SURE] for a in at.tolist()]
            picked = [ahead[k * len(ahead) // SAMPLES] for k in range(SAMPLES)] if ahead else []
            yield pa.RecordBatch.from_arrays([pa.array(picked, pa.binary())], names=["s"])

    drawn = texts.mapInArrow(run, "s binary").orderBy(F.xxhash64("s"), "s").limit(DECIDING * shards)
    picked = sorted(bytes(r.s) for r in drawn.collect())  # bounded by the shards
    return sorted({picked[k * len(picked) // shards] for k in range(1, shards)}) if picked else []


def _runs(texts: DataFrame, splitters: list[bytes]) -> DataFrame:
    """Front-coded runs by shard, and (shard -1) the spans that a run settles by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _text_rows(batches):
            kept, equal = _condensed(_records(rows))
            spans = [(sha, a - most, a - least + LENGTH) for _, _, sha, a, least, most in equal]
            out = []
            if spans:
                out.append((-1, b"", b"", "\n".join(f"{s} {a} {b}" for s, a, b in spans).encode()))
            cuts = [0, *(_first_at(kept, s) for s in splitters), len(kept)]
            for shard, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                if a < b:
                    out.append((shard, *_front_coded(kept[a:b])))
            kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["shard", "numbers", "strings", "names"])

    return texts.mapInArrow(run, "shard int, numbers binary, strings binary, names binary")


def _condensed(records: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """One of all records equal on both sides, with their number, and those of which all strings are repeated."""
    kept, equal = [], []
    k = 0
    while k < len(records):
        end = k + 1
        while end < len(records) and records[end][0] == records[k][0] and records[end][1] == records[k][1]:
            end += 1
        if end - k > 1:  # equal on both sides: all strings of these anchors are repeated
            equal += records[k:end]
        # one goes on, with the widest range of strings
        widest = records[k]
        kept.append((*widest[:4], min(r[4] for r in records[k:end]), widest[5], end - k))
        k = end
    return kept, equal


def _first_at(records: list[tuple], splitter: bytes) -> int:
    low, high = 0, len(records)
    while low < high:
        middle = (low + high) // 2
        low, high = (middle + 1, high) if records[middle][0][:SURE] < splitter else (low, middle)
    return low


def _front_coded(records: list[tuple]) -> tuple[bytes, bytes, bytes]:
    """Numbers (prefix, rest, left size, text, anchor, least, copies), strings and names of a sorted run."""
    shared = _neighbour_prefixes([r[0] for r in records], LENGTH)
    names = {n: k for k, n in enumerate(dict.fromkeys(r[2] for r in records))}
    numbers = np.array([
        (s, len(r[0]) - s, len(r[1]), names[r[2]], r[3], r[4], min(r[6], 2)) for r, s in zip(records, shared.tolist(), strict=True)
    ], "<i8")
    strings = b"".join(r[0][s:] + r[1] for r, s in zip(records, shared.tolist(), strict=True))
    return numbers.tobytes(), strings, "\n".join(names).encode()


def _decoded(numbers: bytes, strings: bytes, names: bytes) -> Iterator[tuple[bytes, int, tuple]]:
    listed, before, at = names.decode().split("\n"), b"", 0
    for shared, rest, left, text, anchor, least, copies in np.frombuffer(numbers, "<i8").reshape(-1, 7).tolist():
        before = before[:shared] + strings[at:at + rest]
        at += rest
        yield before, shared, (strings[at:at + left], listed[text], anchor, least, copies)
        at += left


def _resolve(group: list[tuple[int, tuple]]) -> Iterator[tuple[str, int, int]]:
    """Spans of repeated strings among records whose neighbours share at least ``SURE`` bytes to the right.

    Level by level of the common prefix v: records that share v bytes to the right repeat the strings that start from
    ``LENGTH - v`` to the records' common bytes to the left before their anchors.
    """
    shared = np.array([s for s, _ in group])
    shared[0] = 0
    for level in sorted({int(s) for s in shared[1:]}, reverse=True):
        heads = np.flatnonzero(shared < level)
        for a, b in zip(heads, [*heads[1:], len(group)], strict=True):
            if b - a < 2 or (shared[a + 1:b] > level).all():
                continue  # nothing new at this level
            order = sorted(range(a, b), key=lambda k: group[k][1][0])
            lefts = _neighbour_prefixes([group[k][1][0] for k in order], WINDOW)
            for place, k in enumerate(order):
                left, sha, anchor, least, copies = group[k][1]
                reach = max(int(lefts[place]), int(lefts[place + 1]) if place + 1 < len(order) else 0)
                near = max(LENGTH - level, least)
                if copies < 2 and near <= min(reach, len(left)):
                    yield sha, anchor - min(reach, len(left)), anchor - near + LENGTH


def _merged(runs: DataFrame) -> DataFrame:
    """Spans of repeated strings from all runs of each shard."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["numbers", "strings", "names"]).to_pylist()
        tree = LoserTree([_decoded(r["numbers"], r["strings"], r["names"]) for r in rows])
        spans: list[tuple[str, int, int]] = []
        group: list[tuple[int, tuple]] = []
        for _, shared, record in tree:
            if shared < SURE and len(group) > 1:
                spans += _resolve(group)
            if shared < SURE:
                group = []
            group.append((shared, record))
        if len(group) > 1:
            spans += _resolve(group)
        columns = list(zip(*spans, strict=True)) or [()] * 3
        return pa.table([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["sha", "start", "end"])

    return runs.groupBy("shard").applyInArrow(run, "sha string, start long, end long")


def _hot_records(texts: DataFrame) -> DataFrame:
    """``sha, anchor, near, far, copies, right, left`` of the anchors listed; without copies, a run has settled them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _text_rows(batches):
            kept, equal = _condensed(_records(rows))
            out = [(sha, a, least, most, None, None, None) for _, _, sha, a, least, most in equal]
            out += [(sha, a, least, most, min(copies, 2), right, left) for right, left, sha, a, least, most, copies in kept]
            columns = list(zip(*out, strict=True)) or [()] * 7
            kinds = [pa.string(), *[pa.int64()] * 4, pa.binary(), pa.binary()]
            names = ["sha", "anchor", "near", "far", "copies", "right", "left"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return texts.mapInArrow(run, "sha string, anchor long, near long, far long, copies long, right binary, left binary")


def _prints(distance_right: Column, distance_left: Column) -> Column:
    """128 bits of hash of what is common to strings that start between the two distances before their anchors."""
    right, left = F.col("right").substr(F.lit(1), F.lit(LENGTH) - distance_right), F.col("left").substr(F.lit(1), distance_left)
    return F.struct(F.xxhash64(right, left).alias("one"), F.xxhash64(F.lit(1), left, right).alias("two"))


def _counted(texts: DataFrame) -> DataFrame:
    """Spans of repeated strings at anchors whose next bytes are so frequent that no task may hold all of them.

    The string that starts d bytes before its anchor is known by ``LENGTH - d`` bytes to the right and d to the left,
    and repeated if this occurs twice.  Distances are counted a node at a time first.  If no other anchor has what all
    strings of the node have in common, none is repeated; if another has all that the node's strings reach, all are;
    such anchors are one class.  The strings of what is left are counted by themselves, against one of each class.  All
    strings of an anchor contain it, so its first and last repeated one make one span.  Counts are added up in each task
    before they are exchanged, and only keys that occur once are joined to their one anchor, so no key is hot.
    """
    found = stage(_hot_records(texts).withColumn("id", F.monotonically_increasing_id()), "hot")
    open_ = found.where("copies is not null")
    low, high = F.col("node") * NODE, F.col("node") * NODE + NODE - 1
    asked = (
        open_.select("*", F.explode(F.sequence(F.floor(F.col("near") / NODE), F.floor(F.col("far") / NODE))).alias("node"))
        .withColumn("whole", (F.col("near") <= low) & (F.col("far") >= high))
        .select(
            "id", "node", "copies", _prints(high, low).alias("common"), F.when(F.col("whole"), _prints(low, high)).alias("all"),
            F.when(~F.col("whole"), F.col("id")).alias("part"),
        )
    )
    lonely = asked.groupBy("node", "common").agg(F.sum("copies").alias("n"), F.min("id").alias("id")).where("n = 1").select("id", "node", F.lit(True).alias("lonely"))
    nodes = stage(
        asked.groupBy("node", "all", "part").agg(F.sum("copies").alias("n"), F.min("id").alias("id"))
        .join(lonely, ["id", "node"], "left")
        .select("id", "node", "n", (F.col("part").isNotNull() | (F.col("n") == 1)).alias("single"), F.coalesce("lonely", F.lit(False)).alias("lonely")),
        "nodes",
    )
    once = (
        nodes.where("not lonely").join(open_.select("id", "near", "far", "right", "left"), "id")
        .select("id", "n", "right", "left", F.explode(F.sequence(F.greatest(low, "near"), F.least(high, "far"))).alias("distance"))
        .select("n", "id", "distance", _prints(F.col("distance"), F.col("distance")).alias("string"))
        .groupBy("distance", "string").agg(F.sum("n").alias("n"), F.min("id").alias("id")).where("n = 1").select("id", "distance")
    )
    # What is known of each anchor's nodes and distances; a node or distance of which nothing is said is repeated.
    no = F.lit(None).cast("long")
    known = (
        nodes.where("single").select("id", F.when(F.col("lonely"), F.col("node")).alias("gone"), no.alias("once"))
        .unionByName(once.select("id", no.alias("gone"), F.col("distance").alias("once")))
        .groupBy("id").agg(F.collect_set("gone").alias("gone"), F.collect_set("once").alias("once"))  # at most WINDOW
    )
    nothing = F.array().cast("array<long>")
    repeated_ = F.filter(
        F.sequence("near", "far"),
        lambda d: ~F.array_contains(F.coalesce("gone", nothing), F.floor(d / NODE)) & ~F.array_contains(F.coalesce("once", nothing), d),
    )
    spans = (
        open_.select("id", "sha", "anchor", "near", "far").join(known, "id", "left").withColumn("distances", repeated_).where(F.size("distances") > 0)
        .select("sha", (F.col("anchor") - F.array_max("distances")).alias("start"), (F.col("anchor") - F.array_min("distances") + LENGTH).alias("end"))
    )
    return found.where("copies is null").select("sha", F.expr("anchor - far").alias("start"), (F.col("anchor") - F.col("near") + LENGTH).alias("end")).unionByName(spans)


def _settled(runs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [line.split(" ") for raw in batch.column(0).to_pylist() for line in raw.decode().split("\n")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), *(pa.array([int(r[k]) for r in rows], pa.int64()) for k in (1, 2))],
                names=["sha", "start", "end"],
            )

    return runs.where("shard < 0").select("names").mapInArrow(run, "sha string, start long, end long")


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs covered by spans."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def repeated(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Described documents (``doc_id, sha, n_bytes, copies``) and ``sha, spans, kept_sha256, kept`` of texts with spans."""
    described = stage(_describe(docs), "anchors")
    texts = described.groupBy("sha").agg(F.count("*").alias("copies"), F.any_value("hashes").alias("hashes"))
    places = stage(texts.where(F.size("hashes") > 0).select("sha", F.explode("hashes").alias("hash")), "places")
    often = places.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash", (F.col("n") > HOT_RECORDS).alias("hot"))
    wanted = places.join(often, "hash").groupBy("sha").agg(
        F.collect_set(F.when(~F.col("hot"), F.col("hash"))).alias("hashes"), F.collect_set(F.when(F.col("hot"), F.col("hash"))).alias("hot")
    )
    open_ = stage(
        _once(docs).join(wanted, "sha").groupBy("sha").agg(*(F.first(c).alias(c) for c in ("text", "hashes", "hot"))), "open"
    )
    records, hot = open_.agg(*(F.coalesce(F.sum(F.size(c)), F.lit(0)) for c in ("hashes", "hot"))).head()
    source = open_.where(F.size("hashes") > 0).select("sha", "text", "hashes")
    shards = max(64, -(-records // SHARD_RECORDS))
    runs = stage(_runs(source, _splitters(source, shards)), "runs")
    spans = _settled(runs).unionByName(_merged(runs.where("shard >= 0")))
    if hot:
        spans = spans.unionByName(_counted(open_.where(F.size("hot") > 0).select("sha", "text", "hot")))
    by_text = spans.groupBy("sha").agg(F.collect_set(F.struct("start", "end")).alias("spans"))  # at most two per anchor and level

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for sha, text, found in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                joined = joined_spans([(s["start"], s["end"]) for s in found])
                ends = [0, *(x for span in joined for x in span), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
                rows.append((sha, [{"start": a, "end": b} for a, b in joined], hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["sha", "spans", "kept_sha256", "kept"])

    done = open_.select("sha", "text").join(by_text, "sha").select("sha", "text", "spans").mapInArrow(
        cut, "sha string, spans array<struct<start:bigint,end:bigint>>, kept_sha256 string, kept binary"
    )
    return described.select("doc_id", "sha", "n_bytes").join(texts.select("sha", "copies"), "sha"), done


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of all documents.

    A missing text is empty; texts of fewer than ``LENGTH`` bytes stay whole; equal texts of at least ``LENGTH`` bytes
    are removed as a whole, all of them.  Rows with equal ids are texts of their own.
    """
    described, done = repeated(docs)
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return described.join(done.drop("kept"), "sha", "left").select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce(removed, F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce(F.size("spans"), F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, hashlib.sha256(b"").hexdigest()).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
