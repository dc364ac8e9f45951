"""Many terms looked up in one pass over each text: an Aho-Corasick automaton over Arrow batches.

The time is linear in the text and its hits, whatever the number of terms.  Texts of a batch are searched as one string;
what stands beside a hit is looked up for all hits at once.
"""

from __future__ import annotations

import itertools
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

#: Characters searched as one string; a longer text is searched by itself.
TOGETHER = 1_000_000
#: Terms of one automaton at most: every worker holds it (some 200 bytes a character of the terms).
MAX_TERMS = 1_000_000
_GAP = "\n"  # between texts; neither a letter nor a digit


@lru_cache(maxsize=1)
def word_characters() -> np.ndarray:
    """For each code point, whether it is a letter or digit of any script."""
    return np.fromiter((unicodedata.category(chr(c))[0] in "LN" for c in range(0x110000)), bool, 0x110000)


@dataclass(frozen=True)
class Hits:
    """All hits, also overlapping ones: text, pattern and first character of each, and whether both sides are word edges."""

    text: np.ndarray
    pattern: np.ndarray
    start: np.ndarray
    edged: np.ndarray


class Automaton:
    """Finds distinct non-empty patterns; a pattern's number is its place in the list."""

    def __init__(self, patterns: Sequence[str]) -> None:
        import ahocorasick

        if len(patterns) > MAX_TERMS:
            raise ValueError(f"{len(patterns)} terms; an automaton holds {MAX_TERMS} at most")
        self.sizes = np.array([len(p) for p in patterns], np.int64)
        self.machine = ahocorasick.Automaton()
        for number, pattern in enumerate(patterns):
            self.machine.add_word(pattern, number)
        self.machine.make_automaton()

    def search(self, texts: Sequence[str | None]) -> Iterator[tuple[int, int, Hits]]:
        """Hits of texts in groups: first text, the one after the last, and their hits (numbers count from the first)."""
        first, size = 0, 0
        for k, text in enumerate(texts):
            size += len(text or "") + 1
            if size >= TOGETHER:
                yield first, k + 1, self._hits(texts[first:k + 1])
                first, size = k + 1, 0
        if first < len(texts):
            yield first, len(texts), self._hits(texts[first:])

    def _hits(self, texts: Sequence[str | None]) -> Hits:
        joined = _GAP.join([t or "" for t in texts] + [""])
        if not len(self.machine) or len(joined) == 1:
            return Hits(*(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, bool))
        found = np.fromiter(itertools.chain.from_iterable(self.machine.iter(joined)), np.int64).reshape(-1, 2)
        sizes = np.array([len(t or "") for t in texts], np.int64)
        begins = np.cumsum(sizes + 1) - sizes - 1
        pattern, last = found[:, 1], found[:, 0]
        at = last - self.sizes[pattern] + 1
        text = np.searchsorted(begins, at, "right") - 1
        inside = last < (begins + sizes)[text]  # a pattern may contain what stands between texts
        pattern, last, at, text = pattern[inside], last[inside], at[inside], text[inside]
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        words = word_characters()
        before = (at > 0) & words[points[np.maximum(at - 1, 0)]]
        return Hits(text, pattern, at - begins[text], ~before & ~words[points[last + 1]])


@lru_cache(maxsize=8)
def automaton(patterns: tuple[str, ...]) -> Automaton:
    """One automaton per worker and list of patterns."""
    return Automaton(patterns)
