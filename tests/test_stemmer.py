"""Porter's stemmer: published examples, a second formulation in SQL, and its use in retrieval."""

import itertools

import duckdb
import pytest
from pyspark.sql import functions as F

from pulsemart.functions.stemmer import porter, porter_stems
from pulsemart.functions.tokens import tokens
from pulsemart.operators import search
from pulsemart.sources import postings
from verification.stemmer_sql import stems

# Words and stems as published with the algorithm.
PUBLISHED = """
caresses caress, ponies poni, ties ti, caress caress, cats cat, feed feed, agreed agre, plastered plaster, bled bled, motoring motor,
sing sing, conflated conflat, troubled troubl, sized size, hopping hop, tanned tan, falling fall, hissing hiss, fizzed fizz,
failing fail, filing file, happy happi, sky sky, relational relat, conditional condit, rational ration, valenci valenc,
hesitanci hesit, digitizer digit, conformabli conform, radicalli radic, differentli differ, vileli vile, analogousli analog,
vietnamization vietnam, predication predic, operator oper, feudalism feudal, decisiveness decis, hopefulness hope,
callousness callous, formaliti formal, sensitiviti sensit, sensibiliti sensibl, triplicate triplic, formative form, formalize formal,
electriciti electr, electrical electr, hopeful hope, goodness good, revival reviv, allowance allow, inference infer,
airliner airlin, gyroscopic gyroscop, adjustable adjust, defensible defens, irritant irrit, replacement replac, adjustment adjust,
dependent depend, adoption adopt, homologou homolog, communism commun, activate activ, angulariti angular, homologous homolog,
effective effect, bowdlerize bowdler, probate probat, rate rate, cease ceas, controll control, roll roll,
generalizations gener, oscillators oscil, connect connect, connected connect, connecting connect, connection connect,
connections connect, yes ye, by by, as as, toy toi, say sai, enjoyment enjoy, archaeology archaeolog, university univers, news new
"""


@pytest.mark.parametrize(("word", "stem"), [p.split() for p in PUBLISHED.split(",")])
def test_published_examples(word, stem):
    assert porter(word) == stem


def test_equals_the_sql_formulation():
    """Every stem with every ending, and with two endings after another."""
    begins = ["", "b", "st", "a", "y", "ty", "hop", "fall", "fizz", "sky", "agr", "oper", "say", "trouble", "é", "4x", "queu", "wax", "conflat", "ion", "contr", "яд"]
    endings = """s ss sses ies ed eed ing ated bled ized y ational tional enci anci izer bli alli entli eli ousli ization ation ator
    alism iveness fulness ousness aliti iviti biliti logi icate ative alize iciti ical ful ness al ance ence er ic able ible ant
    ement ment ent sion tion ion ou ism ate iti ous ive ize e ll le""".split()
    words = {b + "".join(e) for b in begins for n in (0, 1, 2) for e in itertools.product(endings, repeat=n)}
    words = sorted(w for w in words if w and "yy" not in w)
    assert len(words) > 50_000
    base = duckdb.connect()
    base.execute("create table words as select unnest(?) w", [words])
    got = dict(base.execute(f"with {stems('words')} select w, stem from stems").fetchall())
    assert len(got) == len(words)
    assert {w: (porter(w), s) for w, s in got.items() if porter(w) != s} == {}


def test_lists_of_words(spark):
    rows = [(0, ["connected", None, "feed"]), (1, None), (2, []), (3, ["ponies"] * 3), (4, [None])]
    df = spark.createDataFrame(rows, "i int, words array<string>").repartition(2)
    got = {r.i: r.s for r in df.select("i", porter_stems("words").alias("s")).collect()}
    assert got == {0: ["connect", None, "feed"], 1: None, 2: [], 3: ["poni"] * 3, 4: [None]}
    assert df.limit(0).select(porter_stems("words")).collect() == []


def test_analysis_with_the_stemmer(values):
    got = values(tokens(F.col("text"), stem="porter"), ["The Connections were TROUBLED", None, "", "the"])
    assert got == [["connect", "were", "troubl"], None, [], []]
    with pytest.raises(ValueError, match="unknown stemmer"):
        tokens(F.col("text"), stem="other")


def test_a_query_finds_other_forms(spark, tmp_path):
    rows = [(1, "a delayed refund"), (2, "refunds delaying"), (3, "nothing here"), (4, None)]
    table = search.search_table(spark.createDataFrame(rows, "event_id int, text string"), stem="porter")
    for query in ("delays", "delayed refunding"):
        hits = search.top_matches(table, query, stem="porter").collect()
        assert {r.event_id for r in hits} == {1, 2}
        index = postings.write_postings(table, str(tmp_path / query.replace(" ", "-")))
        found = postings.best_matching(spark, index, query, stem="porter").collect()
        assert {r.event_id: pytest.approx(r.score) for r in found} == {r.event_id: r.score for r in hits}
    assert search.top_matches(search.search_table(spark.createDataFrame(rows, "event_id int, text string")), "delays").count() == 0
