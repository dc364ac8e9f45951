import datetime as dt
import gzip
import json
import pathlib
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsemart.operators import cursors, enrich, monitors, quality, raw, search, serving, versions
from pulsemart.settings import DateRange
from pulsemart.sources import dimensions, landing, tables
from pulsemart.streaming import jobs

T0 = dt.datetime(2024, 3, 4, 12)


def hours(n):
    return T0 + dt.timedelta(hours=n)


# ---------------------------------------------------------------- versions
VERSION = "event_id string, ts_event timestamp, nlp_processed_at timestamp, created_utc bigint, text string"


def test_latest_version_prefers_processed_then_event_time(spark):
    rows = [("a", hours(5), None, 9, "raw"), ("a", hours(0), hours(1), 1, "done"), ("b", hours(1), None, None, "old"),
            ("b", hours(2), None, None, "new"), ("c", hours(1), hours(1), None, "x"), ("c", hours(1), hours(1), 3, "y")]
    df = spark.createDataFrame(rows, VERSION)
    once = versions.latest_version(df, ["event_id"], versions.EVENT_RECENCY)
    assert {r.event_id: r.text for r in once.collect()} == {"a": "done", "b": "new", "c": "y"}
    again = versions.latest_version(once, ["event_id"], versions.EVENT_RECENCY)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.collect()))


def test_latest_version_limits_each_key_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", hours(0), None, 1, "x")], VERSION).repartition(2)
    plan = versions.latest_version(df, ["event_id"], versions.EVENT_RECENCY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_merge_updates_only_newer_and_does_not_depend_on_order(spark):
    schema = "event_id int, ts_event timestamp, edited timestamp, text string"
    stored = spark.createDataFrame([(1, hours(0), None, "s1"), (2, hours(0), hours(9), "s2"), (3, hours(0), None, "s3")], schema)
    new = spark.createDataFrame([(1, hours(0), hours(1), "n1"), (2, hours(0), hours(2), "n2"), (3, hours(0), None, "n3"), (4, hours(0), None, "n4")], schema)
    stamp = F.coalesce("edited", "ts_event")

    def merged(target, updates):
        return sorted((r.event_id, r.text) for r in versions.merge_latest(target, updates, ["event_id"], stamp).collect())

    want = [(1, "n1"), (2, "s2"), (3, "s3"), (4, "n4")]
    assert merged(stored, new) == want
    once = versions.merge_latest(stored, new, ["event_id"], stamp)
    assert merged(once, new) == want
    assert merged(stored, new.orderBy(F.desc("event_id")).repartition(3)) == want


def test_duplicate_reports(spark):
    rows = spark.createDataFrame([("a", hours(i), None, i, "t") for i in range(4)] + [("b", hours(0), None, 0, "t")], VERSION)
    rate = versions.duplicate_rate(rows, "event_id").collect()[0]
    assert (rate.total_rows, rate.unique_events, rate.duplicate_count, rate.duplicate_percentage, rate.alert) == (5, 2, 3, 60.0, True)
    assert [tuple(r) for r in versions.most_duplicated(rows, "event_id").collect()] == [("a", 4)]
    audit = versions.duplicate_audit(rows, rows.filter("created_utc = 0"), "event_id").collect()
    assert [(r.table_name, r.duplicate_count) for r in audit] == [("Deduplicated", 0), ("Original", 3)]


# ------------------------------------------------------------------ tables
def test_upsert_is_idempotent_and_keeps_the_first_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "event_id int, v int, stamp int, dt date"
    d1, d2, d3 = (dt.date(2024, 1, d) for d in (1, 2, 3))
    first = spark.createDataFrame([(1, 10, 1, d1), (2, 20, 1, d2), (3, 30, 1, d3)], schema)
    later = spark.createDataFrame([(1, 11, 2, d2), (2, 19, 0, d2), (4, 40, 1, d1), (4, 41, 2, d1)], schema)
    for batch in (first, later, later, first):
        tables.upsert(spark, path, batch, ["event_id"], ["stamp"])
    rows = sorted((r.event_id, r.v, str(r.dt)) for r in spark.read.parquet(path).collect())
    assert rows == [(1, 11, "2024-01-01"), (2, 20, "2024-01-02"), (3, 30, "2024-01-03"), (4, 41, "2024-01-01")]


def test_upsert_keeps_rows_without_a_time(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "event_id int, v int, stamp int, dt date"
    day = dt.date(2024, 1, 1)
    first = spark.createDataFrame([(1, 10, 1, None), (2, 20, 1, None), (3, 30, 1, day)], schema)
    later = spark.createDataFrame([(2, 21, 2, None), (4, 40, 1, None), (5, 50, 1, day)], schema)
    timed = spark.createDataFrame([(1, 11, 2, day)], schema)  # stays where it was first put
    for batch in (first, later, later, timed):
        tables.upsert(spark, path, batch, ["event_id"], ["stamp"])
    rows = sorted((r.event_id, r.v, str(r.dt)) for r in spark.read.parquet(path).collect())
    assert rows == [(1, 11, "None"), (2, 21, "None"), (3, 30, "2024-01-01"), (4, 40, "None"), (5, 50, "2024-01-01")]


def dated(spark, rows):
    return spark.createDataFrame([(k, dt.date(2024, 1, d) if d else None, v, f"t{k}") for k, d, v in rows], "id int, dt date, stamp int, text string")


def stored(spark, path):
    return sorted(((r.id, r.stamp, r.dt) for r in spark.read.parquet(path).collect()), key=lambda r: r[:2])


def test_upsert_reads_only_touched_partitions(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.upsert(spark, path, dated(spark, [(k, k % 20 + 1, 1) for k in range(100)]), ["id"], ["stamp"])
    seen = []
    merge = tables.merged_versions
    monkeypatch.setattr(tables, "merged_versions", lambda old, *rest: seen.append(old) or merge(old, *rest))
    # key 3 lives in the fourth, wherever its update says; key 500 is new
    tables.upsert(spark, path, dated(spark, [(3, 9, 2), (500, 6, 1)]), ["id"], ["stamp"])
    text = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*dt#\d+ IN \(2024-01-04,2024-01-06\)", text)
    rows = stored(spark, path)
    assert len(rows) == 101 and (3, 2, dt.date(2024, 1, 4)) in rows


def test_upsert_of_a_table_without_an_index(spark, tmp_path):
    path = str(tmp_path / "t")
    dated(spark, [(1, 1, 1), (2, None, 1)]).write.partitionBy("dt").parquet(path)
    tables.upsert(spark, path, dated(spark, [(1, 5, 2), (2, 5, 2), (3, 5, 2)]), ["id"], ["stamp"])
    assert stored(spark, path)[0] == (1, 2, dt.date(2024, 1, 1)) and {r[0]: r[2] for r in stored(spark, path)}[2] is None


def test_many_partitions_are_picked_by_a_join(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "NAMED_PARTITIONS", 2)
    path = str(tmp_path / "t")
    tables.upsert(spark, path, dated(spark, [(k, k % 9, 1) for k in range(40)]), ["id"], ["stamp"])
    tables.upsert(spark, path, dated(spark, [(k, 1, 2) for k in range(0, 40, 7)]), ["id"], ["stamp"])
    rows = [tuple(r) for r in spark.read.parquet(path).select("id", "stamp", "dt").collect()]
    assert sorted((k, s) for k, s, _ in rows) == [(k, 2 if k % 7 == 0 else 1) for k in range(40)]
    assert all((d.day if d else 0) == k % 9 for k, _, d in rows)


def test_an_interrupted_swap_is_ended_by_the_next_upsert(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.upsert(spark, path, dated(spark, [(1, 1, 1), (2, 2, 1)]), ["id"], ["stamp"])
    before = stored(spark, path)

    def fails(*_):
        raise RuntimeError("lost")

    put = tables._put_in_place
    monkeypatch.setattr(tables, "_put_in_place", fails)
    with pytest.raises(RuntimeError):
        tables.upsert(spark, path, dated(spark, [(1, 1, 5), (3, 2, 5)]), ["id"], ["stamp"])
    assert stored(spark, path) == before
    monkeypatch.setattr(tables, "_put_in_place", put)
    tables.upsert(spark, path, dated(spark, [(4, 1, 1)]), ["id"], ["stamp"])
    assert [(k, s) for k, s, _ in stored(spark, path)] == [(1, 5), (2, 1), (3, 5), (4, 1)]
    assert not list(tmp_path.glob("t.pending-*"))
    # the key that the interrupted upsert never entered in the index is not doubled
    tables.upsert(spark, path, dated(spark, [(3, 2, 9)]), ["id"], ["stamp"])
    assert [(k, s) for k, s, _ in stored(spark, path)] == [(1, 5), (2, 1), (3, 9), (4, 1)]


def test_an_incomplete_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(spark, path, dated(spark, [(1, 1, 1)]), ["id"], ["stamp"])
    broken = F.udf(lambda x: 1 // 0, "int")
    with pytest.raises(Exception):
        tables.upsert(spark, path, dated(spark, [(1, 1, 5)]).withColumn("stamp", broken("id")), ["id"], ["stamp"])
    assert stored(spark, path) == [(1, 1, dt.date(2024, 1, 1))]


def test_an_append_after_lost_index_entries_adds_nothing_twice(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.append_new(spark, path, dated(spark, [(1, 1, 1)]), ["id"])
    add = tables.KeyIndex.add
    monkeypatch.setattr(tables.KeyIndex, "add", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        tables.append_new(spark, path, dated(spark, [(2, 1, 1), (3, 2, 1)]), ["id"])
    monkeypatch.setattr(tables.KeyIndex, "add", add)
    tables.append_new(spark, path, dated(spark, [(2, 1, 1), (3, 2, 1), (4, 2, 1)]), ["id"])
    assert [k for k, _, _ in stored(spark, path)] == [1, 2, 3, 4]


def test_append_new_and_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 1))], "id int, dt date")
    tables.append_new(spark, path, rows, ["id"])
    tables.append_new(spark, path, rows.unionByName(spark.createDataFrame([(3, dt.date(2024, 1, 2))], "id int, dt date")), ["id"])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    stored = spark.read.parquet(path)
    out = tables.replace_with_backup(stored.filter("id > 1"), path, str(tmp_path / "backup"))
    assert sorted(r.id for r in out.collect()) == [2, 3]
    assert spark.read.parquet(str(tmp_path / "backup")).count() == 3


def test_mart_is_partitioned_and_pruned(spark, tmp_path):
    path = str(tmp_path / "m")
    rows = [("b", dt.date(2024, 1, d), "US", d) for d in range(1, 6)]
    tables.write_mart(spark.createDataFrame(rows, "brand_id string, date date, country string, v int"), path)
    one = spark.read.parquet(path).filter("date = date'2024-01-03'")
    assert "PartitionFilters: [isnotnull(date" in one._jdf.queryExecution().executedPlan().toString()
    assert [r.v for r in one.collect()] == [3]


def test_registry(spark):
    tables.register_sources(spark, {"feed_a": spark.range(3).toDF("id")})
    assert spark.sql("select count(*) n from feed_a").collect()[0].n == 3


def test_landing_skips_bad_lines_and_prunes_days(spark, tmp_path):
    for day, lines in {"2024-01-01": ['{"event_id": "a"}', "not json", "", '{"event_id": "b"']}.items():
        folder = tmp_path / f"dt={day}"
        folder.mkdir()
        with gzip.open(folder / "part-1.jsonl.gz", "wt") as f:
            f.write("\n".join(lines + [json.dumps({"event_id": "c", "extra": 1})]))
    rows = landing.read_landing(spark, str(tmp_path), "event_id string")
    assert sorted(r.event_id for r in rows.collect()) == ["a", "c"] and rows.count() == 2
    assert landing.read_landing(spark, str(tmp_path), "event_id string", DateRange(start="2024-02-01")).count() == 0


def test_dictionary_file(spark, tmp_path):
    file = tmp_path / "brands.csv"
    file.write_text('brand_id,brand_name,aliases,domains,ticker,hq_country\nx,"X, Bank","[""X1"", ""X2""]","[""x.com""]",X,US\n')
    row = dimensions.read_brand_dictionary(spark, str(file)).collect()[0]
    assert (row.brand_name, row.aliases, row.domains) == ("X, Bank", ["X1", "X2"], ["x.com"])
    assert dimensions.brand_dictionary(spark).count() == 7


# ----------------------------------------------------------------- cursors
def test_cutoff(values):
    expr = cursors.fetch_cutoff(F.col("since"), F.col("cursor"), F.lit("2024-03-04 12:00:00").cast("timestamp"))
    base = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    rows = [(None, "2024-03-04T12:00:00Z"), (100, None), (base, "2024-01-01T00:00:00Z"), (None, None)]
    assert values(expr, rows, "since bigint, cursor string") == [base - 7200, 0, base - 7200, base - 7 * 86400]
    expr = cursors.fetch_cutoff(F.col("since"), F.col("cursor"), F.lit("2024-03-04 12:00:00").cast("timestamp"), initial=F.lit(True))
    assert values(expr, rows, "since bigint, cursor string") == [base - 7 * 86400] * 4


def test_cursor_moves_only_forward(spark):
    state = spark.createDataFrame([("s", "2024-03-04T12:00:00Z", "x", hours(0)), ("s", "2024-03-04T10:00:00Z", "w", hours(-5)),
                                   ("q", "2024-03-04T12:00:00Z", "x", hours(0))], "source string, cursor_iso string, tie_breaker_id string, updated_at timestamp")
    seen = spark.createDataFrame([("s", hours(3), "a"), ("s", hours(3), "b"), ("q", hours(0), "z"), ("n", hours(-99), "k")],
                                 "source string, ts_event timestamp, native_id string")
    out = cursors.advance_cursor(seen, state, F.lit(hours(4))).collect()
    assert sorted((r.source, r.cursor_iso, r.tie_breaker_id) for r in out) == [
        ("n", "2024-02-29T09:00:00Z", "k"), ("q", "2024-03-04T12:00:00Z", "z"), ("s", "2024-03-04T15:00:00Z", "b")]
    # The stored second with its own id, or a smaller one, moves nothing, whatever the fraction.
    stay = spark.createDataFrame([("q", hours(0) + dt.timedelta(milliseconds=700), "x"), ("s", hours(0), "a")], seen.schema)
    assert cursors.advance_cursor(stay, state, F.lit(hours(4))).collect() == []


# --------------------------------------------------------------- retrieval
def test_bm25_equals_brute_force(spark):
    rnd = random.Random(3)
    words = "fee card loan bank atm call".split()
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 30))) for _ in range(60)]
    table = search.search_table(spark.createDataFrame(list(enumerate(texts)), "event_id int, text string"))
    out = {r.event_id: r.score for r in search.relevance(table, "fees atm").collect()}
    docs = [t.split() for t in texts]
    mean = sum(map(len, docs)) / len(docs)
    for i, doc in enumerate(docs):
        want = 0.0
        for term in ("fee", "atm"):
            df, tf = sum(term in d for d in docs), doc.count(term)
            want += np.log(1 + (60 - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(doc) / mean))
        assert out[i] == pytest.approx(want)
    top = search.top_matches(table, "fees atm", 3).collect()
    assert [r.event_id for r in top] == sorted(out, key=lambda i: (-out[i], i))[:3]


def test_diverse_picks_of_a_missing_topic(spark):
    df = spark.createDataFrame([(t, f"k{i}", 1.0 / (i + 1), [1.0, float(i)]) for t in (None, "a") for i in range(5)], "topic string, k string, score double, v array<double>")
    picks = [(r.topic, r.pick) for r in search.diverse(df, "topic", "k", "score", "v", limit=3).collect()]
    assert sorted(picks, key=repr) == sorted([(t, p) for t in (None, "a") for p in (1, 2, 3)], key=repr)


def test_diverse_equals_greedy_pick(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, i % 2, float(rnd.random()), [float(x) for x in rnd.normal(size=4)]) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, topic int, score double, v array<double>")
    out = search.diverse(df, "topic", "k", "score", "v", limit=6).collect()
    for topic in (0, 1):
        pool = sorted((r for r in rows if r[1] == topic), key=lambda r: (-r[2], r[0]))
        unit = {r[0]: np.array(r[3]) / np.linalg.norm(r[3]) for r in pool}
        picked = []
        while len(picked) < 6:
            rest = [r for r in pool if r[0] not in picked]
            gain = [round(0.7 * r[2] - 0.3 * max((float(unit[r[0]] @ unit[p]) for p in picked), default=0), 9) for r in rest]
            picked.append(rest[int(np.argmax(gain))][0])
        assert [r.k for r in sorted((r for r in out if r.topic == topic), key=lambda r: r.pick)] == picked


def brute_diverse(rows, limit, weight=0.7):
    """Greedy picks of one topic; rows are (key, score, vector)."""
    unit = [np.array(v) / max(np.linalg.norm(v), 1e-12) for _, _, v in rows]
    left, picked, taken = set(range(len(rows))), [], []
    while left and len(picked) < limit:
        def order(i):
            near = max((float(unit[i] @ unit[p]) for p in taken), default=0.0)
            return -round(weight * rows[i][1] - (1 - weight) * near, 9), -rows[i][1], rows[i][0]
        best = min(left, key=order)
        taken.append(best)
        picked.append(rows[best][0])
        left = {i for i in left if rows[i][0] != rows[best][0]}
    return picked


@pytest.mark.parametrize("head", [1, 3, 1000])
def test_diverse_with_a_small_head(spark, head):
    """Crowds of like vectors with high scores: most picks lie far below the first head."""
    rnd = np.random.default_rng(7)
    rows = [(i, "crowd", 0.9 + 0.1 * float(rnd.random()), [1.0, 0.01 * float(rnd.random()), 0.0]) for i in range(60)]
    rows += [(100 + i, "crowd", 0.6 + 0.1 * float(rnd.random()), [float(x) for x in rnd.normal(size=3)]) for i in range(60)]
    rows += [(200 + i % 5, None, float(rnd.random()), [float(x) for x in rnd.normal(size=3)]) for i in range(30)]  # repeated keys
    rows += [(300, "one", 0.5, [0.0, 0.0, 0.0]), (301, "one", 0.5, [0.0, 0.0, 0.0])]
    odd = [(400, "one", 0.9, None), (401, "one", None, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows + odd, "k int, topic string, score double, v array<double>").repartition(5)
    out = search.diverse(df, "topic", "k", "score", "v", limit=8, head=head).collect()
    for topic in ("crowd", None, "one"):
        want = brute_diverse([(k, s, v) for k, t, s, v in rows if t == topic], 8)
        assert [r.k for r in sorted((r for r in out if r.topic == topic), key=lambda r: r.pick)] == want


def test_diverse_of_nothing_and_of_unequal_vectors(spark):
    schema = "k int, topic string, score double, v array<double>"
    assert search.diverse(spark.createDataFrame([], schema), "topic", "k", "score", "v").collect() == []
    df = spark.createDataFrame([(1, "a", 0.9, [1.0, 0.0]), (2, "a", 0.8, [1.0]), (3, "a", 0.7, [1.0, 0.0])], schema)
    assert [r.k for r in sorted(search.diverse(df, "topic", "k", "score", "v").collect(), key=lambda r: r.pick)] == [1, 2, 3]


def test_nearest_is_exact(spark):
    rnd = np.random.default_rng(1)
    data = rnd.normal(size=(50, 8))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)] + [(99, [0.0] * 8), (98, None)], "event_id int, dense_vec array<double>")
    ask = F.array(*[F.lit(float(x)) for x in data[7]])
    got = [r.event_id for r in search.nearest(df, ask, 5).collect()]
    sim = data @ data[7] / np.linalg.norm(data, axis=1)
    assert got == list(np.argsort(-sim)[:5])


# ----------------------------------------------------- serving and quality
def test_pages(spark):
    rows = [(f"c{i:02d}", dt.date(2024, 1, 1) + dt.timedelta(i // 10), "low", "a" if i % 2 else "b") for i in range(25)]
    df = spark.createDataFrame(rows, "complaint_id string, complaint_date date, severity_level string, cluster_name string")
    pages = [[r.complaint_id for r in serving.complaint_page(df, "all", p, 10).collect()] for p in (1, 2, 3, 4)]
    assert [len(p) for p in pages] == [10, 10, 5, 0] and len({c for p in pages for c in p}) == 25
    env = serving.page_envelope(df, "a", 2, 10).collect()[0]
    assert (env.total_count, env.total_pages, env.has_next_page, env.has_previous_page) == (12, 2, False, True)


def test_checks(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "b", 200.0), (None, None, None), (None, "zz", -1.0)], "id int, kind string, v double")
    out = {r.check_name: (r.failures, r.passed) for r in quality.run_checks(df, "t", [
        quality.NotNull("id"), quality.Unique(("id",)), quality.Unique(("id", "kind")),
        quality.AcceptedValues("kind", ("a", "b")), quality.AcceptedRange("v", 0, 100), quality.NotNull("v")]).collect()}
    assert out == {"not_null:id": (2, False), "unique:id": (1, False), "unique:id,kind": (0, True),
                   "accepted_values:kind": (1, False), "accepted_range:v": (2, False), "not_null:v": (1, False)}


def test_alerts(spark):
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    df = spark.createDataFrame(list(zip(["x"] * 3, days, [10, 15, 16], [0.1, 0.1, 0.7])), "brand_id string, date date, complaints int, severity double")
    out = {str(r.date): (r.volume_alert, r.severity_alert) for r in monitors.alerts(df).collect()}
    assert out == {"2024-01-02": (True, False), "2024-01-03": (False, True)}


# --------------------------------------------------------------- streaming
SCHEMA = "event_id string, ts_event timestamp, brand_id string, value double"


def land(spark, path, rows):
    landing.write_landing(spark.createDataFrame(rows, SCHEMA), path)


def test_stream_keeps_late_rows_and_drops_repeats(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    land(spark, src, [("a", hours(0), "x", 1.0), ("a", hours(0), "x", 1.0), ("b", hours(1), "x", 2.0)])

    def run():
        jobs.append_unique(jobs.landing_stream(spark, src, SCHEMA), out, state).awaitTermination()
        return sorted(r.event_id for r in spark.read.parquet(out).collect())

    assert run() == ["a", "b"]
    land(spark, src, [("b", hours(1), "x", 2.0), ("c", hours(2), "x", 2.0)])
    assert run() == ["a", "b", "c"]
    assert run() == ["a", "b", "c"]
    land(spark, src, [("d", hours(-30), "x", 2.0), ("a", hours(0), "x", 1.0)])
    assert run() == ["a", "b", "c", "d"]


def test_late_events_change_days_and_alerts(spark, tmp_path):
    src, events, daily, alerts, state = (str(tmp_path / n) for n in ("src", "events", "daily", "alerts", "state"))

    def run(rows):
        land(spark, src, rows)
        stream = jobs.landing_stream(spark, src, SCHEMA)
        jobs.alert_on_spikes(stream, jobs.DailyTables(events, daily), alerts, state, F.col("value")).awaitTermination()
        volumes = sorted((str(r.date), r.volume) for r in spark.read.parquet(daily).collect())
        found = {(str(r.date), r.volume, r.previous_volume, r.change_pct) for r in spark.read.parquet(alerts).filter("alert").collect()}
        return volumes, found

    first = [(f"a{i}", hours(0), "x", 1.0) for i in range(4)] + [(f"b{i}", hours(24), "x", 1.0) for i in range(6)]
    assert run(first) == ([("2024-03-04", 4), ("2024-03-05", 6)], {("2024-03-05", 6, 4, 50.0)})
    # Late events of the day before: its volume rises, and the alert of the next day goes.
    late = [("a9", hours(1), "x", 1.0), ("a0", hours(0), "x", 1.0)]
    assert run(late) == ([("2024-03-04", 5), ("2024-03-05", 6)], set())


def test_staged_tables_are_deleted(spark, tmp_path):
    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir"))
    before = sorted(p.name for p in shared.iterdir())
    rows = spark.createDataFrame([("a", hours(0), "x", 1.0)], SCHEMA).withColumn("dt", F.to_date("ts_event"))
    for _ in range(2):
        tables.upsert(spark, str(tmp_path / "t"), rows, ["event_id"], ["ts_event"])
        tables.append_new(spark, str(tmp_path / "t"), rows, ["event_id"])
    assert sorted(p.name for p in shared.iterdir()) == before


def test_stored_row_wins_ties(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda v, h: spark.createDataFrame([(f"k{i}", hours(h), "x", v) for i in range(20)], SCHEMA).withColumn("dt", F.to_date("ts_event"))
    for value, stamp in ((1.0, 0), (2.0, 0), (3.0, 0)):
        tables.upsert(spark, path, frame(value, stamp), ["event_id"], ["ts_event"])
    assert {r.value for r in spark.read.parquet(path).collect()} == {1.0}
    tables.upsert(spark, path, frame(4.0, 1).limit(5), ["event_id"], ["ts_event"])
    assert spark.read.parquet(path).groupBy("value").count().orderBy("value").collect() == [(1.0, 15), (4.0, 5)]


def test_re_enrichment_keeps_members_and_lines(spark, tmp_path):
    folder = tmp_path / "dt=2024-01-01"
    folder.mkdir()
    lines = [{"text": "a great service, thanks a lot for it", "extra": {"deep": [1, 2.5]}, "sentiment": 9, "n": None}, {"text": "", "sentiment": 5}, {"other": 1}]
    (folder / "part-1.txt").write_text("\n".join([*map(json.dumps, lines), "not json", '{"text": "cut'] ) + "\n")
    enrich.re_enrich(spark, str(tmp_path), DateRange("2024-01-01", "2024-01-01"), F.lit("2024-02-01").cast("timestamp"))
    stored = [r.value for r in spark.read.text(str(tmp_path)).collect()]
    assert {"not json", '{"text": "cut', json.dumps(lines[1]), json.dumps(lines[2])} < set(stored) and len(stored) == 5
    (done,) = [json.loads(v) for v in stored if "great" in v]
    assert done["extra"] == {"deep": [1, 2.5]} and done["n"] is None and done["sentiment"] != 9 and done["nlp_processed_at"]


def test_only_the_failing_text_is_neutral(spark):
    def scorer(texts):
        if texts.str.contains("bad").any():
            raise ValueError("cannot score")
        return pd.DataFrame({"sentiment": 0.5, "severity": 0.25, "topics": [["t"]] * len(texts), "language": "en", "confidence": 0.9})

    df = spark.createDataFrame([(i, "bad" if i == 37 else f"text {i}") for i in range(100)], "i int, text string").coalesce(1)
    out = {r.i: (r.sentiment, r.nlp_error) for r in enrich.score_with(df, scorer, "m", "1", F.lit("2024-01-01").cast("timestamp")).collect()}
    assert out.pop(37) == (0.0, "cannot score") and set(out.values()) == {(0.5, None)}


def test_date_range_reads_only_near_day_folders(spark, tmp_path):
    rows = spark.createDataFrame([(str(d), "b", "text", f"2024-01-{d:02d}T08:00:00") for d in range(1, 20)], "tweet_id string, brand_id string, text string, ts_event string")
    rows = rows.selectExpr("*", "1L as like_count", "1L as reply_count", "1L as retweet_count", "1L as quote_count", "ts_event as collected_at")
    landing.write_landing(rows, str(tmp_path))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    posts = raw.twitter_posts(landing.read_landing(spark, str(tmp_path), schema), DateRange("2024-01-05", "2024-01-06"))
    assert sorted(r.tweet_id for r in posts.collect()) == ["5", "6"]
    plan = posts._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "2024-01-04" in plan
