"""Written indexes: postings and vector lists, against the plain ways."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulsemart.operators import search
from pulsemart.plans import catalog
from pulsemart.sources import postings, vector_index


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def texts(spark):
    rnd = random.Random(2)
    vocabulary = [f"w{k}" for k in range(40)]
    weights = [1 / (k + 1) for k in range(40)]
    rows = [(f"e{i}", " ".join(rnd.choices(vocabulary, weights, k=rnd.randint(0, 30)))) for i in range(400)]
    rows += [("copy1", rows[7][1]), ("copy2", rows[7][1]), ("blank", ""), ("none", None)]
    table = search.search_table(spark.createDataFrame(rows, "event_id string, text string"))
    return table


@pytest.fixture(scope="module")
def index(spark, texts, tmp_path_factory):
    return postings.write_postings(texts, str(tmp_path_factory.mktemp("postings")), buckets=8, range_rows=8)


@pytest.mark.parametrize("query", ["w3", "w30 w2", "w39 w38 w1 w0", "nothing", "", "w5 nothing w5"])
@pytest.mark.parametrize("limit", [1, 5, 50])
def test_postings_equal_the_scan(spark, texts, index, query, limit):
    want = [(r.event_id, r.score) for r in search.top_matches(texts, query, limit).select("event_id", "score").collect()]
    got = [(r.event_id, r.score) for r in postings.best_matching(spark, index, query, limit).collect()]
    assert [k for k, _ in got] == [k for k, _ in want]
    assert [s for _, s in got] == pytest.approx([s for _, s in want], rel=1e-12)


def test_postings_scores_equal_the_scan(spark, texts, index):
    want = {r.event_id: r.score for r in search.relevance(texts, "w1 w7 w20").filter("score > 0").collect()}
    got = {r.event_id: r.score for r in postings.matching(spark, index, "w1 w7 w20").collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)


def test_postings_read_only_their_terms(spark, index):
    blocks = postings._blocks(spark, index, ["w3"])
    text = plan(blocks)
    assert "PartitionFilters: [" in text and "bucket" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(term,w3)" in text or "In(term" in text
    assert len(blocks.inputFiles()) >= 1
    heads = plan(postings.bounds(blocks, {"w3": 1.0}))
    assert "docs" not in heads.split("ReadSchema")[1]  # bounds come from the block heads


def test_postings_skip_blocks(spark, index):
    blocks = postings._blocks(spark, index, ["w30", "w2"])
    weights = postings._weights(blocks, index, ["w30", "w2"])
    least = postings.threshold(blocks, index, weights, ["w30", "w2"], 2)
    held = postings.bounds(blocks, weights)
    assert 0 < held.filter(F.col("bound") >= least).count() < held.count() / 2


def test_postings_of_an_empty_table(spark, texts, tmp_path):
    index = postings.write_postings(texts.limit(0), str(tmp_path / "none"))
    assert postings.best_matching(spark, index, "w1").collect() == []
    assert postings.matching(spark, index, "w1").collect() == []


# ------------------------------------------------------------------ vectors
def clustered(rows, size=16, seed=1):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 1, (20, size))
    return middles[rng.integers(0, 20, rows)] + rng.normal(0, 0.4, (rows, size))


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [(f"v{i:04d}", [float(x) for x in v]) for i, v in enumerate(clustered(1500))]
    rows += [("zero", [0.0] * 16), ("short", [1.0, 2.0]), ("none", None), ("hole", [None] + [1.0] * 15), ("nan", [float("nan")] * 16)]
    rows += [(f"copy{k}", rows[3][1]) for k in range(5)]
    return spark.createDataFrame(rows, "event_id string, dense_vec array<double>").repartition(3)


@pytest.fixture(scope="module")
def lists(spark, vectors, tmp_path_factory):
    return vector_index.write_vectors(vectors, str(tmp_path_factory.mktemp("vectors")), lists=25)


def asked(values):
    return F.array(*[F.lit(float(x)) for x in values])


def brute(vectors, wanted, limit):
    found = []
    for r in vectors.collect():
        if r.dense_vec is not None and len(r.dense_vec) == len(wanted) and all(x is not None for x in r.dense_vec):
            v = np.array(r.dense_vec)
            if np.isfinite(v).all() and np.linalg.norm(v) > 0:
                found.append((-round(float(v @ wanted / np.linalg.norm(v) / np.linalg.norm(wanted)), 9), r.event_id))
    return [(k, -s) for s, k in sorted(found)[:limit]]


def test_all_lists_are_exact(spark, vectors, lists):
    wanted = clustered(3, seed=5)[1]
    got = [(r.event_id, round(r.similarity, 9)) for r in vector_index.search(spark, lists, asked(wanted), 50, None, None).collect()]
    assert got == brute(vectors, wanted, 50)


def test_every_usable_row_is_indexed(spark, vectors, lists):
    assert spark.read.parquet(f"{lists.path}/lists").count() == 1505


def test_recall_of_probed_lists(spark, vectors, lists):
    queries = vectors.filter("event_id like 'v__50' or event_id like 'v__00'")
    assert 0 < lists.probes < 20  # of 25
    rows = vector_index.recall(spark, lists, queries, "dense_vec", 100).collect()
    assert len(rows) == 30 and all(r.wanted == 100 for r in rows)
    assert np.mean([r.recall for r in rows]) >= 0.9


def test_searches_of_one_and_many_agree(spark, vectors, lists, monkeypatch):
    monkeypatch.setattr(vector_index, "GROUP_ROWS", 20)
    monkeypatch.setattr(vector_index, "GROUP_QUERIES", 3)
    queries = vectors.filter("event_id in ('v0003', 'v0700', 'copy1', 'none', 'zero')")
    many = vector_index.search_many(spark, lists, queries, "dense_vec", 10, probes=6).collect()
    assert {r.asked for r in many} == {"v0003", "v0700", "copy1"}
    for row in queries.filter("event_id like 'v0%'").collect():
        one = vector_index.search(spark, lists, asked(row.dense_vec), 10, probes=6, candidates=200).collect()
        own = sorted((-round(r.similarity, 9), r.key) for r in many if r.asked == row.event_id)
        assert own == sorted((-round(r.similarity, 9), r.event_id) for r in one)


def test_unprobed_lists_are_not_scanned(spark, lists):
    text = plan(vector_index.search(spark, lists, asked(clustered(1)[0]), 10, probes=2))
    scans = [line for line in text.split("\n") if "FileScan" in line]
    assert scans and all(re.search(r"PartitionFilters: \[list#\d+ IN \(\d+,\d+\)", line) for line in scans)
    assert any("code" in line and "unit" not in line for line in scans)  # candidates are picked by the bytes alone


def test_vectors_that_cannot_be_compared(spark, vectors, lists, tmp_path):
    assert vector_index.search(spark, lists, asked([0.0] * 16), 5).collect() == []
    assert vector_index.search(spark, lists, asked([1.0, 2.0]), 5).collect() == []
    empty = vector_index.write_vectors(vectors.limit(0), str(tmp_path / "none"))
    assert vector_index.search(spark, empty, asked([1.0]), 5).collect() == []


# ------------------------------------------------- postings of large tables
def sorted_batches(rows=900, ranges=45, size=70, width=40):
    """Rows in order of their range, with ``width`` tokens each, in Arrow batches."""
    rnd = random.Random(4)
    listed = [[f"t{rnd.randrange(60)}" for _ in range(width)] for _ in range(rows)]
    place = sorted(rnd.randrange(ranges) for _ in range(rows))
    columns = [pa.array(range(rows), pa.int64()), pa.array([width] * rows, pa.int32()), pa.array(place, pa.int64()), pa.array(listed)]
    whole = pa.RecordBatch.from_arrays(columns, names=["key", "length", "range", "tokens"])
    return listed, place, [whole.slice(i, size) for i in range(0, rows, size)]


def test_blocks_are_made_from_bounded_pieces(monkeypatch):
    listed, place, batches = sorted_batches()
    monkeypatch.setattr(postings, "PIECE_TOKENS", 1_000)
    made = list(postings._range_blocks(iter(batches), 40.0, postings.DEFAULT_BM25))
    most = 40 * max(place.count(p) for p in set(place))
    assert len(made) > len(batches) and all(sum(len(k) for k in b["key"].to_pylist()) <= 1_000 + most for b in made)
    got = {}
    for b in made:
        for r in b.to_pylist():
            assert (r["term"], r["range"]) not in got  # a range is never cut
            got[r["term"], r["range"]] = {k: (tf, n) for k, tf, n in zip(r["key"], r["tf"], r["length"], strict=True)}
    want = {}
    for k, words in enumerate(listed):
        for w in set(words):
            want.setdefault((w, place[k]), {})[k] = (words.count(w), 40)
    assert got == want


def test_no_batches_make_no_blocks():
    assert list(postings._range_blocks(iter([]), float("nan"), postings.DEFAULT_BM25)) == []


def test_no_list_of_postings_is_collected_over_a_shuffle(spark, texts, tmp_path, monkeypatch):
    plans = []
    dealt = postings.by_partition
    monkeypatch.setattr(postings, "by_partition", lambda df, *keys: plans.append(plan(df)) or dealt(df, *keys))
    postings.write_postings(texts, str(tmp_path / "lists"))
    assert len(plans) == 1 and "collect_list" not in plans[0] and "MapInArrow" in plans[0] and plans[0].count("Exchange") <= 2


def test_keys_that_come_twice_score_as_one_row(spark, tmp_path):
    rows = [("a", "w1 w2"), ("a", "w1 w1"), ("a", "w3"), (None, "w1"), ("b", "w2 w2 w4"), *((f"c{i}", "w5 w1") for i in range(40))]
    table = search.search_table(spark.createDataFrame(rows, "event_id string, text string").repartition(7))
    index = postings.write_postings(table, str(tmp_path / "twice"), range_rows=2)
    every = {r.event_id: round(r.score, 9) for r in postings.matching(spark, index, "w1 w2 w3").collect()}
    best = {r.event_id: round(r.score, 9) for r in postings.best_matching(spark, index, "w1 w2 w3", 3).collect()}
    assert len(every) == 43 and max(every, key=every.get) == "a"
    assert best["a"] == every["a"] and all(every[k] == s for k, s in best.items())


def test_postings_queries_stage_tokens_only(spark, texts, monkeypatch):
    staged = []
    keep = catalog.stage
    monkeypatch.setattr(catalog.samples, "search_events", lambda *_: texts.select("event_id", "text").withColumn("dense_vec", F.lit(None)))
    monkeypatch.setattr(catalog, "stage", lambda df, name: staged.append(df.columns) or keep(df, name))
    assert catalog.postings_match(spark, "").columns == ["event_id", "score"]
    assert catalog.relevance_match(spark, "").columns == ["event_id", "score"]
    assert staged == [["event_id", "tokens", "token_count"], ["event_id", "text", "tokens", "token_count"]]
