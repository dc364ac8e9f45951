"""Collocations by prefix-free parsing: n-grams are counted inside the distinct chunks of all texts.

1. Texts are cut into chunks at places that their own words choose (a hash of two neighbouring words), so equal passages
   give equal chunks wherever they stand.  A chunk goes on for up to four words beyond the next cut, but not beyond its
   piece; it owns the n-grams that start before the cut, so each n-gram of a text belongs to exactly one chunk.
2. The distinct chunks with their frequencies are the dictionary of the parse.  All counts are taken in the dictionary
   alone, each n-gram times the frequency of its chunk.
3. Phrases are counted length by length.  A phrase can be frequent only if both its longest parts are, so only places
   where a bit table (of fixed size, set from the frequent phrases before) has both are counted.  The table can pass too
   many, never too few; counts are exact.
4. Cuts of the candidates find the counts of their parts by joins on the phrase; longer candidates send their count to
   the phrases inside them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsemart.llm.common import stage, text_of
from pulsemart.llm.words import PLACES, mixed, parts, word_hashes

#: Words of a phrase at most, occurrences of a candidate at least, rows of each language's report.
LONGEST, LEAST, TOP = 5, 100, 2000
#: A chunk starts at one of so many places; text bytes handled at once.
PERIOD, SLICE_BYTES = 32, 4_000_000
#: Bits of the table of frequent phrases (2 MB), in blocks that are merged on their own.
TABLE_BITS, BLOCK_BYTES = 1 << 24, 4096

# Bytes that end a piece, and white space between words.
_ENDS, _SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"
_CLASS = np.zeros(256, np.uint8)
_CLASS[list(_SPACES)] = 1
_CLASS[list(_ENDS)] = 2


def _spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``data``, one after the other."""
    ends = np.cumsum(lengths)
    return data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)]


def _strings(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Byte strings that lie in a row."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


class Words:
    """Words of texts in a row: where each starts and ends, its text, whether a piece starts with it, and its hash."""

    def __init__(self, data: np.ndarray, text_starts: np.ndarray) -> None:
        kinds = _CLASS[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[text_starts] = True
        inside = kinds == 0
        before = np.concatenate([[False], inside[:-1]]) & ~edge[:-1]
        self.starts = np.flatnonzero(inside & ~before)
        after = np.concatenate([inside[1:], [False]]) & ~edge[1:]
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.lengths = self.ends - self.starts
        marks = np.cumsum(kinds == 2)
        self.text = np.searchsorted(text_starts, self.starts, "right") - 1
        same_piece = np.zeros(len(self.starts), bool)
        if len(self.starts):
            at = marks[self.starts]
            same_piece[1:] = (at[1:] == at[:-1]) & (self.text[1:] == self.text[:-1])
        self.heads = ~same_piece
        coded = _strings(_spans(data, self.starts, self.lengths), self.lengths).dictionary_encode()
        self.distinct = coded.dictionary
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.word_hashes = word_hashes(self.distinct.to_pylist())
        self.hashes = self.word_hashes[self.codes]

    def left(self) -> np.ndarray:
        """How many words of its piece follow each word, itself included."""
        heads = np.flatnonzero(self.heads)
        ends = np.append(heads[1:], len(self.starts))
        return np.repeat(ends, np.diff(np.append(heads, len(self.starts)))) - np.arange(len(self.starts))


def _row(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, A-Z lower-cased, and where each text starts, with the end."""
    texts = texts.cast(pa.large_binary())
    sizes = np.asarray(pc.binary_length(texts)).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(texts.to_pylist()), np.uint8)
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data), starts


def chunks(texts: pa.Array, period: int = PERIOD) -> pa.Array:
    """Chunks of the texts: the number of words beyond what the chunk owns (a digit), then its words.

    Words of a piece are joined by a space, pieces by a line feed.
    """
    data, text_starts = _row(texts)
    words = Words(data, text_starts)
    count = len(words.starts)
    if not count:
        return pa.array([], pa.large_binary())
    triggers = mixed(words.hashes * PLACES[0] + np.append(words.hashes[1:], np.uint64(0)) * PLACES[1])
    first_of_text = np.concatenate([[True], words.text[1:] != words.text[:-1]])
    # two words of one text choose a cut before the second
    cut = np.concatenate([[False], (triggers[:-1] >> np.uint64(20)) % np.uint64(period) == 0]) | first_of_text
    heads = np.flatnonzero(cut)
    owned_ends = np.append(heads[1:], count)
    beyond = np.minimum(words.left()[owned_ends - 1] - 1, LONGEST - 1)
    # the words again, each with the mark behind it
    sizes = words.lengths + 1
    place = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.empty(place[-1], np.uint8)
    ahead = np.append(words.heads[1:], True)
    marks = place[1:] - 1
    body = np.ones(place[-1], bool)
    body[marks] = False
    flat[body] = _spans(data, words.starts, words.lengths)
    flat[marks] = np.where(ahead, 10, 32)
    begins, ends = place[heads], place[owned_ends + beyond] - 1
    lengths = ends - begins + 1  # with the digit
    out = np.empty(int(lengths.sum()), np.uint8)
    digit = np.cumsum(lengths) - lengths
    body = np.ones(len(out), bool)
    body[digit] = False
    out[digit] = 48 + beyond
    out[body] = _spans(flat, begins, ends - begins)
    return _strings(out, lengths)


def _counted(values: pa.Array, weights: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
    """Distinct values and their (weighted) numbers."""
    coded = values.dictionary_encode()
    numbers = coded.indices.to_numpy(zero_copy_only=False)
    out = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(out, numbers, 1 if weights is None else weights)
    return coded.dictionary, out


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    """Rows of each language (first column) of a batch."""
    coded = batch.column(0).dictionary_encode()
    numbers = coded.indices.to_numpy(zero_copy_only=False)
    for k, lang in enumerate(coded.dictionary.to_pylist()):
        yield lang, batch.take(pa.array(np.flatnonzero(numbers == k)))


def dictionary(docs: DataFrame, period: int = PERIOD) -> DataFrame:
    """The distinct chunks of all texts: ``lang, chunk, freq``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text", SLICE_BYTES):
                for lang, own in _by_language(part):
                    found, numbers = _counted(chunks(own.column(1), period))
                    yield from _rows(lang, found, numbers, ["lang", "chunk", "freq"])

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_of().alias("text"))
    return rows.mapInArrow(run, "lang string, chunk binary, freq long").groupBy("lang", "chunk").agg(F.sum("freq").alias("freq"))


def _rows(lang: str, values: pa.Array, numbers: np.ndarray, names: list[str], kind: pa.DataType | None = None) -> Iterator[pa.RecordBatch]:
    values = values.cast(kind or pa.binary()) if len(values) else pa.array([], kind or pa.binary())
    whole = pa.RecordBatch.from_arrays([pa.array([lang] * len(values), pa.string()), values, pa.array(numbers, pa.int64())], names=names)
    for at in range(0, whole.num_rows, 50_000):
        yield whole.slice(at, 50_000)


class Chunks:
    """Words of a batch of chunks, with each word's weight and whether its chunk owns it."""

    def __init__(self, values: pa.Array, freq: np.ndarray) -> None:
        raw = values.cast(pa.large_binary())
        self.data = np.frombuffer(b"".join(raw.to_pylist()), np.uint8)
        sizes = np.asarray(pc.binary_length(raw)).astype(np.int64)
        ends = np.cumsum(sizes)
        data = self.data.copy()
        digits = ends - sizes
        beyond = data[digits] - 48
        data[digits] = 10
        self.words = words = Words(data, np.append(ends - sizes, ends[-1:]))
        per = np.bincount(words.text, minlength=len(sizes)) if len(words.text) else np.zeros(len(sizes), np.int64)
        left_in_chunk = np.repeat(np.cumsum(per), per) - np.arange(len(words.text))
        self.owned = left_in_chunk > np.repeat(beyond.astype(np.int64), per)
        self.weights = np.repeat(freq, per)
        self.left = words.left()

    def grams(self, size: int) -> np.ndarray:
        """Hash of the phrase of ``size`` words from each word on; meaningless where the piece ends before."""
        out = np.zeros(len(self.words.hashes), np.uint64)
        for k in range(size):
            out[:max(0, len(out) - k)] += self.words.hashes[k:] * PLACES[k]
        return mixed(out)

    def phrases(self, at: np.ndarray, size: int) -> pa.Array:
        """The phrases of ``size`` words that start at the words ``at``."""
        starts = self.words.starts[at]
        lengths = self.words.ends[at + size - 1] - starts
        return _strings(_spans(self.data, starts, lengths), lengths)


def _bits(lang: str, hashes: np.ndarray, size: int) -> np.ndarray:
    """Bit numbers of a language's phrases in a table of ``size`` bits."""
    seed = word_hashes([lang.encode()])[0]
    return ((mixed(hashes ^ seed) >> np.uint64(13)) % np.uint64(size)).astype(np.int64)


def _phrase_hashes(phrases: pa.Array, size: int) -> np.ndarray:
    coded = pc.split_pattern(phrases.cast(pa.large_string()), " ").flatten().dictionary_encode()
    hashes = word_hashes([w.encode() for w in coded.dictionary.to_pylist()])[coded.indices.to_numpy(zero_copy_only=False)]
    grid = hashes.reshape(-1, size)
    out = np.zeros(len(grid), np.uint64)
    for k in range(size):
        out += grid[:, k] * PLACES[k]
    return mixed(out)


def bit_table(frequent: DataFrame, size: int, bits: int = TABLE_BITS) -> np.ndarray:
    """A table with the bits of all frequent phrases of ``size`` words; it has ``bits`` bits whatever their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for lang, own in _by_language(batch):
                at = _bits(lang, _phrase_hashes(own.column(1), size), bits)
                np.bitwise_or.at(table, at >> 3, (1 << (at & 7)).astype(np.uint8))
        yield from _blocks(table)

    def merge(group: pa.Table) -> pa.Table:
        block = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in group["bits"].to_pylist()])
        return pa.table({"block": group["block"].slice(0, 1), "bits": pa.array([block.tobytes()], pa.binary())})

    schema = "block int, bits binary"
    found = frequent.select("lang", "phrase").mapInArrow(run, schema).groupBy("block").applyInArrow(merge, schema)
    table = np.zeros(bits // 8, np.uint8)
    for row in found.collect():  # the table's own size at most
        table[row.block * BLOCK_BYTES:(row.block + 1) * BLOCK_BYTES] = np.frombuffer(row.bits, np.uint8)
    return table


def _blocks(table: np.ndarray) -> Iterator[pa.RecordBatch]:
    grid = table.reshape(-1, BLOCK_BYTES)
    used = np.flatnonzero(grid.any(1))
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([grid[k].tobytes() for k in used], pa.binary())], names=["block", "bits"])


def counts(parse: DataFrame, size: int, table: np.ndarray | None) -> DataFrame:
    """``lang, phrase, f`` of the phrases of ``size`` words, those whose parts the table (of one word less) has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _joined(batches):
            for lang, own in _by_language(batch):
                read = Chunks(own.column(1), np.asarray(own.column(2)))
                wanted = read.owned & (read.left >= size)
                if table is not None:
                    places = _bits(lang, read.grams(size - 1), 8 * len(table))
                    known = (table[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1
                    wanted &= known & np.append(known[1:], False)
                at = np.flatnonzero(wanted)
                found, numbers = _counted(read.phrases(at, size), read.weights[at])
                yield from _rows(lang, found, numbers, ["lang", "phrase", "f"], pa.string())

    return parse.select("lang", "chunk", "freq").mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at least ``SLICE_BYTES``: a phrase is sent once for each."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= SLICE_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def mine(docs: DataFrame, least: int = LEAST, top: int | None = TOP, period: int = PERIOD, bits: int = TABLE_BITS) -> DataFrame:
    """Collocations of all texts, best first per language: ``lang, rank, phrase, a, l, r, n, score``.

    A missing language counts as ``und``, a missing text as empty.  Copies count as often as they occur.  A text
    without words adds nothing; other columns and ids have no effect; an empty table gives no rows.  Ties end with the
    phrase in byte order.  ``top=None`` returns all collocations.  ``period`` and ``bits`` change the work, never the rows.
    """
    parse = stage(dictionary(docs, period), "parse")
    words = stage(counts(parse, 1, None), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    levels = [stage(words.where(F.col("f") >= least), "frequent")]
    for size in range(2, LONGEST + 1):
        table = bit_table(levels[-1], size - 1, bits)
        levels.append(stage(counts(parse, size, table).where(F.col("f") >= least), "frequent"))
    known = levels[0]
    for level in levels[1:]:
        known = known.unionByName(level)

    candidates = levels[1].withColumn("size", F.lit(2))
    for size, level in enumerate(levels[2:], 3):
        candidates = candidates.unionByName(level.withColumn("size", F.lit(size)))
    listed = candidates.withColumn("words", F.split("phrase", " "))
    # of a longer phrase that occurs as often, one with a single word more also does
    inner = (
        listed.where("size > 2")
        .select("lang", F.explode(F.array(F.slice("words", F.lit(1), F.col("size") - 1), F.slice("words", F.lit(2), F.col("size") - 1))).alias("w"), "f")
        .groupBy("lang", F.array_join("w", " ").alias("phrase")).agg(F.max("f").alias("around"))
    )
    left = listed.join(inner, ["lang", "phrase"], "left").where("around is null or 100 * around < 100 * f")
    cuts = left.select(
        "lang", "phrase", F.col("f").alias("a"), "size", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    ).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    )
    sided = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]).join(
        known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]
    ).join(totals, "lang")
    long = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
    # exact: thousands of occurrences squared pass 64 bits, decimals of 38 digits hold them
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * long["a"] * long["n"], long["l"] * long["r"])
    best = sided.withColumn("score", score.cast("long")).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut")
    ).select("lang", "phrase", "cut.*")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order))
    if top:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
