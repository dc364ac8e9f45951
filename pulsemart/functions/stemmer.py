"""Porter's English stemmer (1980, with the two later changes ``bli`` and ``logi``)."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# The published suffix rules.
_NOUNS = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al",
    "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al",
    "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "logi": "log",
}
_ADJECTIVES = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
_ENDINGS = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti",
    "ous", "ive", "ize",
)


def _shape(word: str) -> str:
    """``v`` or ``c`` per letter; y is a vowel after a consonant."""
    shape = ""
    for letter in word:
        vowel = letter in "aeiou" or (letter == "y" and shape.endswith("c"))
        shape += "v" if vowel else "c"
    return shape


def _measure(word: str) -> int:
    """How often a consonant follows a vowel."""
    return _shape(word).count("vc")


def _has_vowel(word: str) -> bool:
    return "v" in _shape(word)


def _doubled(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short(word: str) -> bool:
    """Ends with consonant, vowel, consonant, the last not w, x or y."""
    return _shape(word).endswith("cvc") and word[-1] not in "wxy"


def _replaced(word: str, rules: dict[str, str], holds: Callable[[str, str], bool]) -> str:
    """The longest suffix that fits decides; it is replaced if the condition on the rest holds."""
    suffix = max((s for s in rules if word.endswith(s)), key=len, default=None)
    if suffix is None:
        return word
    rest = word.removesuffix(suffix)
    return rest + rules[suffix] if holds(rest, suffix) else word


def _without_plural(word: str) -> str:
    return _replaced(word, {"sses": "ss", "ies": "i", "ss": "ss", "s": ""}, lambda rest, suffix: True)


def _without_tense(word: str) -> str:
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    cut = _replaced(word, {"ed": "", "ing": ""}, lambda rest, suffix: _has_vowel(rest))
    if cut == word:
        return word
    if cut.endswith(("at", "bl", "iz")) or (_measure(cut) == 1 and _short(cut) and not _doubled(cut)):
        return cut + "e"
    return cut[:-1] if _doubled(cut) and cut[-1] not in "lsz" else cut


def _without_last_e(word: str) -> str:
    if word.endswith("e"):
        rest = word[:-1]
        size = _measure(rest)
        if size > 1 or (size == 1 and not _short(rest)):
            word = rest
    return word[:-1] if word.endswith("ll") and _measure(word) > 1 else word


@lru_cache(maxsize=1 << 17)
def porter(word: str) -> str:
    """The stem of a lower-case word; words of one or two letters stay."""
    if len(word) <= 2:
        return word
    word = _without_tense(_without_plural(word))
    if word.endswith("y") and _has_vowel(word[:-1]):
        word = word[:-1] + "i"
    for rules in (_NOUNS, _ADJECTIVES):
        word = _replaced(word, rules, lambda rest, suffix: _measure(rest) > 0)
    word = _replaced(
        word, dict.fromkeys(_ENDINGS, ""),
        lambda rest, suffix: _measure(rest) > 1 and (suffix != "ion" or rest.endswith(("s", "t"))),
    )
    return _without_last_e(word)


@F.arrow_udf(ArrayType(StringType()))
def porter_stems(words: pa.Array) -> pa.Array:
    """Stems of word lists: every distinct word of a batch is stemmed once."""
    coded = words.flatten().dictionary_encode()
    known = coded.dictionary.to_pylist()
    stems = pa.array([None if w is None else porter(w) for w in known], coded.dictionary.type).take(coded.indices)
    sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype("int32"))
    return pa.ListArray.from_arrays(ends, stems, mask=words.is_null())
