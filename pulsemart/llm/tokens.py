"""Texts to token ids by a public tokenizer, in Arrow batches.

Both tokenizers' rules never reach across ASCII white space, so a text's ids
are the ids of its words in a row.  Each distinct word of a batch is encoded
once, and a bounded cache keeps words between batches.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words kept between batches; beyond, those met in several batches stay, at most half as many.
CACHED_WORDS = 700_000
#: ASCII marks that form a token of their own behind a letter or digit, and such letters and digits.
MARKS = ".,;:!?$%&*#|\"()"
PLAIN_END, PLAIN = "[A-Za-z0-9À-ÖØ-öø-ÿ]$", "^[a-zà-öø-ÿ]+$"
#: Plain words encoded in one call.
TOGETHER = 500
#: Text bytes handled at once.
SLICE_BYTES = 4_000_000


class Encoder:
    """Encodes string arrays with a ``tokenizers`` file; special tokens are not added."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # ids that close a unit, if the tokenizer marks them
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.closing = np.zeros(self.size, bool)
        if suffix:
            self.closing[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.known: dict[str, int] = {"": 0}
        self.ends = np.zeros(1, np.int64)  # of each known word's ids in the pool
        self.hits = np.zeros(1, np.int64)  # batches that each known word was met in
        self.pool = np.zeros(0, np.uint32)

    def _make_room(self) -> None:
        """Forget the words that were met in one batch only, and the least met ones beyond half the cache."""
        often = np.argsort(-self.hits[1:], kind="stable")[:CACHED_WORDS // 2] + 1
        kept = np.concatenate([[0], np.sort(often[self.hits[often] > 1])])
        starts = np.concatenate([[0], self.ends[:-1]])[kept]
        lengths = self.ends[kept] - starts
        names = list(self.known)  # in the order of their numbers
        self.pool, self.ends, self.hits = _gathered(self.pool, starts, lengths), np.cumsum(lengths), self.hits[kept] // 2
        self.known = {names[k]: number for number, k in enumerate(kept.tolist())}

    def _ids(self, words: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        """Groups of new words with their ids and lengths.  A word of letters alone is one unit, so many can share a call."""
        plain = pc.match_substring_regex(pa.array(words, pa.string()), PLAIN).to_numpy(zero_copy_only=False) & self.closing.any()
        single = [w for w, p in zip(words, plain, strict=True) if p]
        groups = [single[k:k + TOGETHER] for k in range(0, len(single), TOGETHER)]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(found.ids, np.uint32)
            yield group, ids, np.diff(np.flatnonzero(self.closing[ids]), prepend=-1)
        other = [w for w, p in zip(words, plain, strict=True) if not p]
        for word, found in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False), strict=True):
            yield [word], np.array(found.ids, np.uint32), np.array([len(found.ids)])

    def _numbers(self, words: list[str]) -> np.ndarray:
        if len(self.known) + len(words) > CACHED_WORDS:
            self._make_room()
        known = self.known
        new = list(dict.fromkeys(w for w in words if w not in known))
        if new:
            names, ids, lengths = zip(*self._ids(new), strict=True)
            first = len(self.ends)
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate(lengths))])
            self.pool = np.concatenate([self.pool, *ids])
            known.update(zip((w for group in names for w in group), range(first, len(self.ends)), strict=True))
            self.hits = np.concatenate([self.hits, np.zeros(len(self.ends) - first, np.int64)])
        numbers = np.fromiter((known[w] for w in words), np.int64, len(words))
        self.hits[numbers] += 1
        return numbers

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words in a row, and their lengths; a word's trailing marks are looked up apart."""
        special = pc.match_substring(words, "<|")  # might be a special token, whose case matters
        small = pc.if_else(special, words, pc.ascii_lower(words))
        cores = pc.utf8_rtrim(small, MARKS)
        cores = pc.if_else(pc.and_not(pc.match_substring_regex(cores, PLAIN_END), special), cores, small)
        tails = _tails(small, cores)
        coded, ends = cores.dictionary_encode(), tails.dictionary_encode()
        names = coded.dictionary.to_pylist()
        numbers = self._numbers(names + ends.dictionary.to_pylist())
        core_numbers, tail_numbers = (np.asarray(x.indices.fill_null(0)).astype(np.int64) for x in (coded, ends))
        both = np.stack([numbers[core_numbers], numbers[len(names) + tail_numbers]], 1).ravel()
        starts = np.concatenate([[0], self.ends])[both]
        lengths = self.ends[both] - starts
        return _gathered(self.pool, starts, lengths), lengths.reshape(-1, 2).sum(1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (uint32), and where each text's ids start, with the end (int64)."""
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        coded = split.flatten().dictionary_encode()
        pool, lengths = self._distinct(coded.dictionary)
        starts, numbers = np.cumsum(lengths) - lengths, coded.indices.to_numpy(zero_copy_only=False)
        lengths = lengths[numbers]
        word_ends = np.concatenate([[0], np.cumsum(lengths)])
        places = np.asarray(split.offsets) - split.offsets[0].as_py()
        return _gathered(pool, starts[numbers], lengths), word_ends[places]

    def slices(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Parts of a batch of about ``SLICE_BYTES``: first row, ids, starts."""
        ends = np.cumsum(np.asarray(pc.binary_length(texts).fill_null(0)), dtype=np.int64)
        row = 0
        while row < len(texts):
            before = ends[row - 1] if row else 0
            to = max(row + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
            yield row, *self.encode(texts.slice(row, to - row))
            row = to


def _tails(words: pa.Array, cores: pa.Array) -> pa.Array:
    """What each word has behind its core."""
    words = words.cast(pa.large_string())
    sizes = np.asarray(pc.binary_length(words)).astype(np.int64)
    lengths = sizes - np.asarray(pc.binary_length(cores)).astype(np.int64)
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(words.cast(pa.large_binary()).to_pylist()), np.uint8)
    found = _gathered(data, ends - lengths, lengths)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(found)))


def _gathered(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of a pool, one after the other."""
    ends = np.cumsum(lengths)
    return pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder, and so one cache, for each Python worker and file."""
    return Encoder(path)
