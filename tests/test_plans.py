"""Shapes of physical plans that must hold at any size."""

import os

import pytest

from pulsemart.plans import catalog
from pulsemart.sources import samples

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [
    n for n in catalog.QUERIES
    if not n.startswith("stream_") and not n.endswith("_roundtrip")
    and n not in {"upserted_table", "upserted_ties", "appended_events", "replaced_with_backup", "landed_posts_in_range", "re_enriched_days",
              "diverse_quotes", "score_quality", "daily_severity", "daily_complaint_trends", "dashboard_summary"}
    and not any(w in n for w in ("match", "evidence", "relevance", "clusters", "samples", "stats", "rollup",
                                 "distribution", "categories", "trend_rows", "peak", "weekly", "hybrid"))
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_or_nested_loop_join(spark, name):
    text = plan(catalog.QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_search_and_cluster_plans_have_no_cross_join(spark):
    for name in ("relevance_scores", "evidence_quotes", "hybrid_match", "complaint_clusters", "dashboard_summary"):
        text = plan(catalog.QUERIES[name](spark, FOLDER))
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_group_limits_come_before_the_shuffle(spark):
    for name in ("latest_versions", "first_comments", "related_queries", "trending_searches"):
        text = plan(catalog.QUERIES[name](spark, FOLDER))
        assert "WindowGroupLimit" in text and "Partial" in text, name


def test_feeds_are_read_once_and_pruned(spark):
    text = plan(catalog.brand_daily_metrics(spark, FOLDER))
    seen = {t: text.count(f"/{t}.parquet") for t in ("lineitem", "conversations", "orders", "events", "customer", "documents")}
    # Documents are both the posts' texts and the complaints' narratives.
    assert seen == {"lineitem": 1, "conversations": 1, "orders": 1, "events": 1, "customer": 1, "documents": 2}
    assert "l_extendedprice" not in text and "o_totalprice" not in text
    # Ranked keywords and peer ranks of volumes nobody publishes are not computed.
    assert "collect_list" not in text


def test_filters_reach_the_scan(spark):
    text = plan(catalog.insert_only_new(spark, FOLDER))
    assert "PushedFilters: [IsNotNull" in text or "PushedFilters: [In(" in text


def test_rollups_read_their_feed_once(spark):
    assert plan(catalog.complaints_daily(spark, FOLDER)).count("/orders.parquet") == 1
    assert plan(catalog.trends_daily(spark, FOLDER)).count("/lineitem.parquet") == 1


@pytest.fixture
def orders_folder(spark, tmp_path):
    tables = {
        "documents": ([(0, "a text", "en"), (2, None, None), (9, "of no order", "de")], "doc_id long, text string, lang string"),
        "orders": (
            [(0, 1, "O", "1-URGENT"), (1, 1, "F", None), (2, 2, "P", "2-HIGH"), (3, 7, "O", "2-HIGH"), (2, 1, "O", "2-HIGH"), (None, 1, "O", "x")],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string"),
        "customer": ([(1, 5, "BUILDING"), (2, 6, None), (2, 5, "HOUSEHOLD")], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "nation": ([(5, "FIVE"), (6, "SIX")], "n_nationkey int, n_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_texts_of_the_export_are_shuffled_once(spark, orders_folder):
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(held, ("-1", "false"), strict=True):
            spark.conf.set(k, v)
        feed = samples.complaints_export_feed(spark, orders_folder)
        text = plan(feed.select("Consumer_complaint_narrative", "State"))
        # The plan lists parents first: the last join is by order and document, the one by customer lies below it.
        joins = [line for line in text.splitlines() if "SortMergeJoin" in line]
        assert len(joins) == 3 and "doc_id" in joins[0] and not any("doc_id" in j for j in joins[1:])
        assert "REPARTITION_BY_NUM" in text
        found = sorted((str(r.Complaint_ID), str(r.Consumer_complaint_narrative), r.State) for r in feed.collect())
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    line = "Order of priority {} with state {}".format
    assert found == sorted([
        ("0", "a text", "FIVE"), ("1", "None", "FIVE"), ("2", line("2-HIGH", "P"), "SIX"), ("2", line("2-HIGH", "P"), "FIVE"),
        ("2", line("2-HIGH", "O"), "FIVE"), ("None", line("x", "O"), "FIVE"),
    ])
