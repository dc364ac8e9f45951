"""Porter's stemmer in SQL: one column per step, conditions as patterns of consonant and vowel runs."""

from __future__ import annotations

# A first y is written Y, so that it counts as a consonant.
_CONSONANTS, _VOWELS = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_SOME = f"^({_CONSONANTS})?{_VOWELS}{_CONSONANTS}"
_MORE = _SOME + _VOWELS + _CONSONANTS
_ONE = f"{_SOME}({_VOWELS})?$"
_VOWEL = f"^({_CONSONANTS})?[aeiouy]"
_SHORT = f"^{_CONSONANTS}[aeiouy][^aeiouwxy]$"

# Suffix and replacement, longer suffixes first.
_SECOND = (
    "ational ate, ization ize, iveness ive, fulness ful, ousness ous, tional tion, biliti ble, entli ent, ousli ous, ation ate, "
    "alism al, aliti al, iviti ive, enci ence, anci ance, izer ize, alli al, ator ate, logi log, bli ble, eli e"
)
_THIRD = "icate ic, ative, alize al, iciti ic, ical ic, ness, ful"
_FOURTH = "ement, ance, ence, able, ible, ment, ant, ent, ion, ism, ate, iti, ous, ive, ize, al, er, ic, ou"


def _suffixes(rules: str, w: str, condition: str) -> str:
    """The first suffix that fits decides, whether or not its condition holds."""
    cases = []
    for rule in rules.split(", "):
        suffix, _, put = rule.partition(" ")
        rest = f"left({w}, -{len(suffix)})"
        holds = f"regexp_matches({rest}, '{condition}')" + (f" and right({rest}, 1) in ('s', 't')" if suffix == "ion" else "")
        cases.append(f"when {w} like '%{suffix}' then case when {holds} then {rest} || '{put}' else {w} end")
    return f"case {' '.join(cases)} else {w} end"


def stems(words: str) -> str:
    """CTEs that end with ``stems(w, stem)`` for the rows ``w`` of the relation ``words``."""
    doubled = "right(c, 1) = left(right(c, 2), 1) and length(c) > 1 and right(c, 1) not in ('a', 'e', 'i', 'o', 'u', 'y', 'l', 's', 'z')"
    return f"""st0 as (select w, case when w like 'y%' then 'Y' || substr(w, 2) else w end a from {words} where length(w) > 2),
st1 as (select w, case when a like '%sses' or a like '%ies' then left(a, -2) when a like '%s' and a not like '%ss' then left(a, -1) else a end a from st0),
st2 as (select w, a, case when a like '%eed' then null
  when a like '%ed' then case when regexp_matches(left(a, -2), '{_VOWEL}') then left(a, -2) end
  when a like '%ing' then case when regexp_matches(left(a, -3), '{_VOWEL}') then left(a, -3) end end c from st1),
st3 as (select w, case
  when a like '%eed' then case when regexp_matches(left(a, -3), '{_SOME}') then left(a, -1) else a end
  when c is null then a
  when c like '%at' or c like '%bl' or c like '%iz' then c || 'e'
  when {doubled} then left(c, -1)
  when regexp_matches(c, '{_SHORT}') then c || 'e' else c end a from st2),
st4 as (select w, case when a like '%y' and regexp_matches(left(a, -1), '{_VOWEL}') then left(a, -1) || 'i' else a end a from st3),
st5 as (select w, {_suffixes(_SECOND, 'a', _SOME)} a from st4),
st6 as (select w, {_suffixes(_THIRD, 'a', _SOME)} a from st5),
st7 as (select w, {_suffixes(_FOURTH, 'a', _MORE)} a from st6),
st8 as (select w, case when a like '%e' and (regexp_matches(left(a, -1), '{_MORE}')
  or (regexp_matches(left(a, -1), '{_ONE}') and not regexp_matches(left(a, -1), '{_SHORT}'))) then left(a, -1) else a end a from st7),
st9 as (select w, case when a like '%ll' and regexp_matches(a, '{_MORE}') then left(a, -1) else a end a from st8),
stems as (select w, case when w like 'y%' then 'y' || substr(a, 2) else a end stem from st9 union all select w, w from {words} where length(w) <= 2)"""
