"""Merged parts against one pass over all rows."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from pulsemart.sources import rollups

SCHEMA = "id string, day date, brand string, value double, author string"


def events(n, seed=3):
    rnd = random.Random(seed)
    return [
        (f"e{i}", rnd.choice([None, dt.date(2024, 1, 1), dt.date(2024, 1, 2)]), rnd.choice(["a", "a", "a", "b", "", None]),
         rnd.choice([None, 1e9 + rnd.random()]), rnd.choice([None, *(f"u{k}" for k in range(9))]))
        for i in range(n)
    ]


def by_hand(rows):
    groups = {}
    for r in rows:
        groups.setdefault((r[1], r[2]), []).append(r)
    out = {}
    for key, own in groups.items():
        values = [r[3] for r in own if r[3] is not None]
        out[key] = (
            len(own), len(values), statistics.fmean(values) if values else None,
            statistics.stdev(values) if len(values) > 1 else None, len({r[4] for r in own} - {None}),
        )
    return out


def check(rollup, rows):
    got = {(r.day, r.brand): r for r in rollup.read().collect()}
    want = by_hand(rows)
    assert set(got) == set(want)
    for key, (volume, valued, mean, spread, members) in want.items():
        r = got[key]
        assert (r.volume, r.valued, r.members_estimate) == (volume, valued, members)
        assert r.mean_value == (mean if mean is None else pytest.approx(mean, rel=1e-12))
        # Values near a thousand million that differ by less than one: sums of squares would lose the deviation.
        assert r.stddev_value == (spread if spread is None else pytest.approx(spread, rel=1e-5))


def add(spark, rollup, number, rows):
    groups = {"day": F.col("day"), "brand": F.col("brand")}
    rollup.add_events(number, spark.createDataFrame(rows, SCHEMA), ["id"], groups, F.col("value"), F.col("author"))


def test_parts_equal_one_pass(spark, tmp_path):
    rows = events(300)
    rollup = rollups.Rollup(spark, str(tmp_path / "r"), ["day", "brand"])
    assert rollup.read() is None
    rollup.compact()
    batches = [rows[:90] + rows[:5], rows[90:200] + rows[40:60], [], rows[200:] + rows[:300:7]]
    for n, batch in enumerate(batches):
        add(spark, rollup, n, batch)
        if n == 1:
            rollup.compact()
    check(rollup, rows)
    rollup.compact()
    check(rollup, rows)


def test_batch_run_again(spark, tmp_path):
    """Also one that failed between its keys and its part, and one already in a base."""
    rows = events(120)
    rollup = rollups.Rollup(spark, str(tmp_path / "r"), ["day", "brand"])
    add(spark, rollup, 0, rows[:60])
    lost, rollup.add = rollup.add, lambda *_: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        add(spark, rollup, 1, rows[50:])
    rollup.add = lost
    check(rollup, rows[:60])
    add(spark, rollup, 1, rows[50:])
    check(rollup, rows)
    rollup.compact()
    add(spark, rollup, 1, rows[50:])
    check(rollup, rows)
    add(spark, rollup, 2, rows)
    check(rollup, rows)


def test_rows_without_a_key_all_count(spark, tmp_path):
    rows = [(None, None, "a", 1.0, None)] * 3 + [("x", None, "a", 2.0, "u")] * 2
    rollup = rollups.Rollup(spark, str(tmp_path / "r"), ["day", "brand"])
    add(spark, rollup, 0, rows)
    check(rollup, rows[:4])


def test_stale_folders_go(spark, tmp_path):
    rollup = rollups.Rollup(spark, str(tmp_path / "r"), ["day", "brand"])
    rows = events(40)
    for n in range(3):
        add(spark, rollup, n, rows[n * 10:n * 10 + 10])
        rollup.compact()
    assert rollup._complete("base") == [1, 2] and rollup._complete("batch") == [2]
    add(spark, rollup, 3, rows[30:])
    assert [s.rsplit("/", 1)[1] for s in rollup._sources()] == ["base-2", "batch-3"]
    check(rollup, rows)


def test_many_members(spark):
    rows = spark.range(60_000).select(F.lit("a").alias("g"), (F.col("id") % 20_000).cast("string").alias("m"), F.col("id").cast("double").alias("v"))
    groups = {"g": F.col("g")}
    cut = [rollups.partial(rows.filter(F.col("v") % 3 == k), groups, F.col("v"), F.col("m")) for k in range(3)]
    out = rollups.figures(rollups.merged(cut[0].unionByName(cut[1]).unionByName(cut[2]), ["g"]), ["g"]).head()
    assert abs(out.members_estimate - 20_000) < 20_000 * 0.05
    assert out.stddev_value == pytest.approx(rows.agg(F.stddev_samp("v")).head()[0], rel=1e-9)
