"""Words and five-word shingles of whole texts as 64-bit numbers, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SHINGLE = 5
#: Odd multipliers of the words' places in a shingle, and of the final mixing.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)
MIX = np.uint64(0xC4CEB9FE1A85EC53)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(29))


def runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of each run of equal values."""
    if not len(values):
        return []
    heads = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])).tolist()
    return list(zip(heads, [*heads[1:], len(values)], strict=True))


def parts(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` text bytes each; a longer text is a slice of its own."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    row = 0
    while row < batch.num_rows:
        to = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + limit, "right")))
        yield batch.slice(row, to - row)
        row = to


def coded_words(texts: pa.Array, lower: bool = True) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, each word's number among them, and where each text's words start, with the end.

    Words are runs of anything but ASCII white space; A-Z are lower-cased; a missing text is empty.
    """
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    flat = split.flatten()
    starts = np.asarray(split.offsets).astype(np.int64) - split.offsets[0].as_py()
    coded = flat.dictionary_encode()
    numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if lower:  # of the distinct words: the function must not see a slice
        coded = pc.ascii_lower(coded.dictionary).dictionary_encode()
        numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[numbers]
    words = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()  # to_pylist takes 20 times as long
    if b"" in words:  # white space at a text's ends
        empty = words.index(b"")
        real = numbers != empty
        starts = np.concatenate([[0], np.cumsum(real)])[starts]
        numbers = numbers[real]
        numbers -= numbers > empty
        words.pop(empty)
    return words, numbers, starts


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of all texts in a row, and where each text's start, with the end.

    ``hashes`` are the words' hashes.  A text of fewer than five words has its whole sequence as its only shingle; a
    text without words has none.
    """
    counts = np.diff(starts)
    windows = np.zeros(len(hashes), np.uint64)
    for k in range(SHINGLE):
        windows[:max(0, len(hashes) - k)] += hashes[k:] * PLACES[k]
    per = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    ends = np.concatenate([[0], np.cumsum(per)])
    at = np.arange(ends[-1]) + np.repeat(starts[:-1] - ends[:-1], per)
    out = windows[at]
    for text in np.flatnonzero((counts > 0) & (counts < SHINGLE)):
        own = hashes[starts[text]:starts[text + 1]]
        own = np.append(own, np.uint64(len(own))) * PLACES[:len(own) + 1]  # the length tells it from a full shingle
        out[ends[text]] = own.sum(dtype=np.uint64)
    return mixed(out), ends
