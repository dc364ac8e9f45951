"""Written pages against sorting, offset and limit."""

import datetime as dt
import random
import re

import pytest

from pulsemart.operators import clusters, features, serving
from pulsemart.plans import catalog
from pulsemart.sources import page_index
from pulsemart.sources.page_index import PageIndex, write_pages

SCHEMA = "complaint_id string, complaint_date date, severity_level string, cluster_name string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def complaints(spark):
    rnd = random.Random(5)
    rows = [
        (f"c{i:03d}", rnd.choice([None, *(dt.date(2024, 1, d) for d in range(1, 6))]), rnd.choice(["high", "medium", "low", "odd", None]),
         rnd.choice(["hot", "hot", "hot", "small", "", None]))
        for i in range(300)
    ]
    rows += [rows[4]] * 3 + [(None, None, None, "hot")]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def by_cluster(spark, complaints, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages") / "by-cluster")
    write_pages(complaints, path, serving.newest_first(), "cluster_name", range_rows=20)
    return PageIndex(spark, path)


@pytest.fixture(scope="module")
def over_all(spark, complaints, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages") / "all")
    write_pages(complaints, path, serving.newest_first(), range_rows=20)
    return PageIndex(spark, path)


def in_order(rows, cluster="all"):
    rank = {"high": 3, "medium": 2, "low": 1}
    kept = [r for r in rows if cluster == "all" or r.cluster_name == cluster]
    return sorted(kept, key=lambda r: (
        r.complaint_date is None, -(r.complaint_date or dt.date.min).toordinal(), -rank.get(r.severity_level, 0),
        r.complaint_id is not None, r.complaint_id or ""))


@pytest.mark.parametrize("size", [1, 7, 50, 1000])
def test_every_page(complaints, over_all, by_cluster, size):
    rows = complaints.collect()
    for index, cluster in ((over_all, "all"), (by_cluster, "hot"), (by_cluster, "")):
        want = in_order(rows, cluster)
        last = -(-len(want) // size)
        numbers = {1, 2, (last + 1) // 2, last, last + 1}
        for n in sorted(n for n in numbers if n > 0):
            assert index.page(n, size, None if cluster == "all" else cluster).collect() == want[(n - 1) * size:n * size]


def test_missing_and_unknown_group(complaints, by_cluster):
    rows = complaints.collect()
    assert by_cluster.page(1, 1000, None).collect() == in_order(rows, None)
    assert by_cluster.page(1, 10, "no such").collect() == [] and by_cluster.total("no such").head().total_count == 0


def test_totals(complaints, over_all, by_cluster):
    assert over_all.total().head().total_count == complaints.count()
    got = serving.envelope(by_cluster.total("hot"), 2, 10).collect()
    assert got == serving.page_envelope(complaints, "hot", 2, 10).collect()


def test_places(complaints, by_cluster):
    placed = by_cluster.placed().collect()
    assert len(placed) == complaints.count()
    for cluster in ("hot", "small", "", None):
        own = sorted((r for r in placed if r.cluster_name == cluster), key=lambda r: r.place)
        assert [r.place for r in own] == list(range(1, len(own) + 1))
        assert [r.complaint_id for r in own] == [r.complaint_id for r in in_order(placed, cluster)]


def test_deep_page_reads_one_range(over_all):
    ranges = over_all.rows.select("_range").distinct().count()
    assert ranges > 10
    deep = over_all.page(30, 10)
    text = plan(deep)
    assert re.search(r"PartitionFilters: \[[^\]]*_range", text)
    assert "GreaterThanOrEqual(_row" in text
    deep.collect()
    assert files_read(deep) <= 2


def files_read(df):
    """Files that the scans of an executed query opened."""
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if name.startswith("Scan"):
            found += node.metrics().apply("numFiles").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_nothing_and_refused_names(spark, tmp_path):
    write_pages(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"), serving.newest_first(), "cluster_name")
    index = PageIndex(spark, str(tmp_path / "none"))
    assert index.page(1, 10, "hot").collect() == [] and index.placed().collect() == []
    assert index.total("hot").head().total_count == 0
    with pytest.raises(ValueError):
        write_pages(spark.createDataFrame([(1,)], "_ROW int"), str(tmp_path / "refused"), [])


def test_pages_hold_complaints_as_shown(spark):
    schema = ("complaint_id string, complaint_text string, severity_level string, source_type string, brand_id string, "
              "complaint_date date, topics array<string>, source_detail string")
    rows = [("a", "the atm is broken", "high", "cfpb", "td", dt.date(2024, 1, 1), None, "x"), (None, None, None, None, None, None, None, None)]
    assigned = clusters.assign_clusters(features.text_features(spark.createDataFrame(rows, schema)))
    shown = serving.page_rows(assigned)
    assert "complaint_text" in shown.columns and not {"cleaned_text", "feature_vector", "word_count"} & set(shown.columns)
    text = plan(shown)
    assert "[a-z0-9]+" not in text and "concat_ws" not in text  # no feature is worked out that only other readers need
    assert sorted(map(str, shown.collect())) == sorted(map(str, assigned.select(*shown.columns).collect()))


def test_the_page_queries_write_these_columns(spark, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(catalog, "_assigned", lambda *_: spark.createDataFrame(
        [("a", "cfpb", "td", "text", dt.date(2024, 1, 1), "hot", "high", "x", "clean")],
        "complaint_id string, source_type string, brand_id string, complaint_text string, complaint_date date, cluster_name string, "
        "severity_level string, source_detail string, cleaned_text string"))
    keep = page_index.write_pages
    monkeypatch.setattr(catalog.page_index, "write_pages", lambda rows, *rest: written.append(rows.columns) or keep(rows, *rest))
    assert [tuple(r) for r in catalog.complaint_places(spark, "").collect()] == [("a", "hot", 1, 1)]
    assert catalog.complaint_last_page(spark, "").count() == 1
    assert [set(c) for c in written] == [set(serving.PAGE_COLUMNS)] * 2
