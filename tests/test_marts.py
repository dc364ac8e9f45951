import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsemart.operators import clusters, daily, features, scoring
from pulsemart.plans import brand_score, complaint_marts
from pulsemart.settings import FourPartWeights, TrendSplit, Weights
from pulsemart.sources import dimensions, schemas

DAY = dt.date(2024, 3, 4)  # a Monday


def frame(spark, schema, rows):
    """Rows given as dicts; missing columns are null."""
    empty = spark.createDataFrame([], schema)
    return spark.createDataFrame([tuple(r.get(c) for c in empty.columns) for r in rows], empty.schema)


def tweet(i, **kw):
    base = dict(brand_id="jpm", tweet_id=str(i), ts_event="2024-03-04T10:00:00", author_id=f"a{i % 2}", text="great bank",
                like_count=5, reply_count=4, retweet_count=2, quote_count=0, possibly_sensitive=False, geo_country="US",
                collected_at="2024-03-04T11:00:00")
    return base | kw


def test_twitter_daily(spark):
    feed = frame(spark, schemas.TWITTER_POSTS, [
        tweet(1), tweet(2, text="awful, damn"), tweet(3, text="plain", quote_count=None, possibly_sensitive=None),
        tweet(4, text=""), tweet(5, brand_id=None), tweet(6, brand_id="wf", geo_country=None),
    ])
    rows = {r.brand_id: r for r in brand_score.twitter_table(feed).collect()}
    jpm = rows["jpm"]
    assert (jpm.posts, jpm.authors, jpm.engagements, jpm.country) == (3, 2, 22, "US")
    assert jpm.sentiment_avg == pytest.approx(0) and jpm.positive_rate == pytest.approx(1 / 3)
    assert jpm.toxicity_rate == pytest.approx(1 / 3) and jpm.high_engagement_rate == pytest.approx(2 / 3)
    assert jpm.sentiment_index == 50 and jpm.min_sample_size_met is False and jpm.anomaly_flag is False
    wf = rows["wf"]
    assert wf.country == "Unknown" and wf.sentiment_stddev is None and wf.volume_index == 0 and wf.sentiment_index == 75


def test_reddit_rows_of_unknown_authors_are_dropped(spark):
    base = dict(brand_id="jpm", ts_event="2024-03-04T10:00:00", type="post", body="solid", score=1, upvote_ratio=0.9, geo_country="US")
    feed = frame(spark, schemas.REDDIT_MESSAGES, [
        base | dict(reddit_id="1", author="x"), base | dict(reddit_id="2", author="[deleted]"),
        base | dict(reddit_id="3", author=None), base | dict(reddit_id="4", author="y", body=None, title=None),
        base | dict(reddit_id="5", author="y", body=None, title="avoid it", type="comment", upvote_ratio=None, score=-3),
    ])
    row = brand_score.reddit_table(feed).collect()[0]
    assert (row.messages, row.posts, row.comments, row.score_sum) == (2, 1, 1, -2)
    assert row.high_upvote_ratio_rate == 1.0 and row.negative_score_rate == 0.5


def test_trends_lag_counts_rows_or_days(spark):
    rows = [
        dict(brand_id="jpm", keyword=k, geo="US-NY", ts_event=f"2024-03-{d:02d}T00:00:00", value=v, is_brand_keyword=k != "c")
        for d, v in [(1, 10), (2, 10), (3, 10), (4, 10), (5, 10), (6, 10), (7, 10), (12, 20)] for k in ("a", "c")
    ]
    feed = frame(spark, schemas.TRENDS_TIMESERIES, rows)
    by_row = {r.date.day: r for r in brand_score.trends_table(feed).collect()}
    assert by_row[12].rsv_trend_7d == 100.0 and by_row[7].rsv_trend_7d is None
    assert by_row[12].country == "US" and by_row[12].region == "US-NY" and by_row[12].regions_covered == 1
    assert [tuple(k) for k in by_row[12].top_keywords] == [("a", 20), ("c", 20)]
    assert by_row[12].brand_category_diff == 0
    by_day = {r.date.day: r for r in brand_score.trends_table(feed, calendar_lag=True).collect()}
    assert by_day[12].rsv_trend_7d == 100.0 and by_day[7].rsv_trend_7d is None
    assert by_day[12].rsv_trend_28d is None


def test_heightened_severity(values):
    expr = daily.heightened_severity(F.lit(0.5), F.col("d"), F.col("t"))
    rows = [(True, False), (True, True), (False, False), (False, True), (None, None), (True, None)]
    assert values(expr, rows, "d boolean, t boolean") == pytest.approx([0.7, 0.6, 0.6, 0.5, 0.5, 0.6])


def test_complaints_daily(spark):
    base = dict(brand_id="jpm", ts_event="2024-03-04T00:00:00", geo_country="US", severity_score=0.5)
    feed = frame(spark, schemas.COMPLAINTS, [
        base | dict(complaint_id="1", product="Credit card or prepaid card", state="NY", timely_response=True, consumer_disputed=False),
        base | dict(complaint_id="2", product="Student loan", state="CA", timely_response=True, consumer_disputed=False,
                    consumer_complaint_narrative="x" * 501),
        base | dict(complaint_id="3", product="Money transfer", state="NY", timely_response=True, consumer_disputed=False),
    ])
    row = brand_score.complaints_table(feed).collect()[0]
    assert (row.complaints, row.product_categories, row.top_product_category, row.top_state) == (3, 3, "Credit Card", "NY")
    assert row.response_quality_index == pytest.approx(100) and row.complaints_volume_index == 100
    assert row.complaints_index == pytest.approx(100) and row.long_narrative_rate == pytest.approx(1 / 3)


METRIC = ("brand_id string, brand_name string, date date, country string, social_sentiment_index double, "
          "social_volume_index double, trends_visibility_index double, cfpb_complaints_index double, "
          "twitter_posts bigint, reddit_messages bigint, trends_rsv_avg double, cfpb_complaints bigint, "
          "min_sample_size_met boolean, anomaly_flag boolean, data_freshness_ok boolean")


def metric(day=DAY, brand="jpm", **kw):
    return dict(brand_id=brand, brand_name=brand, date=day, country="US", twitter_posts=1, reddit_messages=0,
                cfpb_complaints=0, min_sample_size_met=True, anomaly_flag=False, data_freshness_ok=True) | kw


def test_weights_sum_to_one():
    w, f = Weights(), FourPartWeights()
    assert w.social + w.search + w.complaints + w.reviews_customer + w.reviews_employee == pytest.approx(1)
    assert f.social + f.search + f.complaints + f.reviews == pytest.approx(1)


def test_composite_score(spark):
    rows = [
        metric(social_sentiment_index=80.0, trends_visibility_index=60.0, cfpb_complaints_index=40.0),
        metric(brand="wf"), metric(brand="c", social_sentiment_index=0.0, trends_visibility_index=0.0, cfpb_complaints_index=0.0),
    ]
    out = {r.brand_id: r for r in scoring.composite_score(frame(spark, METRIC, rows)).collect()}
    assert out["jpm"].composite_score == pytest.approx(58.5) and out["jpm"].risk_category == "Low Risk"
    assert out["wf"].composite_score == 50 and out["wf"].risk_category == "Low Risk" and out["wf"].composite_rank == 2
    assert out["c"].composite_score == pytest.approx(12.5) and out["c"].risk_category == "High Risk"
    assert out["c"].notes.startswith("Critical") and out["jpm"].notes is None
    assert out["jpm"].composite_percentile == 100 and out["c"].composite_percentile == 0


def test_score_changes_and_notes(spark):
    rows = [metric(DAY + dt.timedelta(d), social_sentiment_index=50.0 + (50 if d == 7 else 0)) for d in range(8)]
    rows += [metric(brand="wf", anomaly_flag=True), metric(brand="c", min_sample_size_met=False)]
    out = {(r.brand_id, r.date): r for r in scoring.composite_score(frame(spark, METRIC, rows)).collect()}
    last = out["jpm", DAY + dt.timedelta(7)]
    assert last.change_7d == pytest.approx(30) and last.trend_direction == "Improving"
    assert last.notes == "Significant change detected"
    assert out["wf", DAY].notes.startswith("Anomaly") and out["c", DAY].notes.startswith("Insufficient")


def test_country_level_trends(spark):
    schema = ("brand_id string, date date, country string, region string, rsv_avg double, brand_rsv_avg double, "
              "category_rsv_avg double, rsv_trend_7d double, rsv_trend_28d double, visibility_index double, "
              "data_points bigint, min_sample_size_met boolean, anomaly_flag boolean")
    rows = [("a", DAY, "US", "US", 10.0, None, 1.0, None, None, 5.0, 1, False, False),
            ("a", DAY, "US", "US-NY", 90.0, 3.0, 2.0, None, None, 6.0, 9, True, True),
            ("b", DAY, "US", "US-NY", 10.0, 4.0, None, None, None, 0.0, 3, True, False),
            ("b", DAY, "US", "US-CA", 30.0, None, None, None, None, 0.0, 1, False, True)]
    out = {r.brand_id: r for r in scoring.country_level_trends(spark.createDataFrame(rows, schema)).collect()}
    assert out["a"].rsv_avg == 10 and out["a"].brand_rsv_avg is None and out["a"].min_sample_size_met is False
    assert out["b"].rsv_avg == 15 and out["b"].brand_rsv_avg == 4 and out["b"].anomaly_flag is True


def test_unknown_country_rows_match_nothing(spark):
    empty_tw = brand_score.twitter_table(frame(spark, schemas.TWITTER_POSTS, []))
    empty_rd = brand_score.reddit_table(frame(spark, schemas.REDDIT_MESSAGES, []))
    empty_tr = brand_score.trends_table(frame(spark, schemas.TRENDS_TIMESERIES, []))
    feed = frame(spark, schemas.COMPLAINTS, [dict(brand_id="td_bank", complaint_id="1", ts_event="2024-03-04T00:00:00", severity_score=0.1)])
    out = scoring.brand_daily_metrics(empty_tw, empty_rd, empty_tr, brand_score.complaints_table(feed), dimensions.brand_dictionary(spark)).collect()
    assert [(r.brand_id, r.brand_name, r.country, r.cfpb_complaints, r.cfpb_timely_rate) for r in out] == [("td", "TD Bank", None, 0, None)]


def test_review_index_and_forecast(spark):
    reviews = spark.createDataFrame(
        [("a", DAY, "US", 5.0, 4.0, 1.0), ("a", DAY, "US", 3.0, None, None)],
        "brand_id string, date date, country string, overall_rating double, culture_values double, ceo_approval double",
    ).withColumns({c: F.lit(None).cast("double") for c in ("work_life_balance", "comp_benefits", "career_opportunities", "senior_management", "recommend_to_friend")})
    row = scoring.employee_review_index(reviews).collect()[0]
    assert row.review_count == 2 and row.employee_review_index == pytest.approx(75)
    scores = spark.createDataFrame([("a", "US", DAY + dt.timedelta(i), 10.0 + 8 * i) for i in range(5)], "brand_id string, country string, date date, composite_score double")
    ahead = scoring.forecast(scores).orderBy("days_ahead").collect()
    assert len(ahead) == 14 and ahead[0].predicted == pytest.approx(50) and ahead[-1].predicted == 100


CASES = [
    ("Unauthorized charge on my account", "low", "fraud_security", 1),
    ("error in my checking account", "high", "account_errors", 2),
    ("they closed my savings", "low", "account_closure", 6), ("my deposit", "medium", "account_issues", 5),
    ("card fee", "low", "card_fees", 6), ("debit payment", "low", "card_issues", 6),
    ("unfair loan", "low", "loan_disputes", 4), ("a mortgage", "low", "loan_issues", 6),
    ("customer service made me angry", "low", "poor_service", 6), ("long call", "low", "service_issues", 6),
    ("I dispute the cost", "low", "fee_disputes", 4), ("money", "low", "fee_issues", 6),
    ("mobile error", "low", "tech_errors", 6), ("atm", "low", "channel_issues", 6),
    ("unreasonable", "low", "general_disputes", 4), ("worst, I am upset", "low", "negative_experience", 3),
    ("too many fees", "low", "general_complaints", 6),
]


def complaints(spark, rows):
    schema = ("complaint_id string, complaint_text string, severity_level string, source_type string, brand_id string, "
              "complaint_date date, topics array<string>, source_detail string")
    return features.text_features(spark.createDataFrame(rows, schema))


def test_every_cluster_rule(spark):
    rows = [(str(i), t, s, "cfpb", "td", DAY, None, "x") for i, (t, s, _, _) in enumerate(CASES)]
    out = {int(r.complaint_id): r for r in clusters.assign_clusters(complaints(spark, rows)).collect()}
    assert [(out[i].cluster_name, out[i].cluster_priority) for i in range(len(CASES))] == [(n, p) for _, _, n, p in CASES]
    assert all(r.cluster_description for r in out.values())


def test_cluster_join_grain(spark):
    levels = ["high"] * 3 + ["medium"] * 3 + ["low"] * 4
    rows = [(str(i), "the atm", s, "reddit" if i % 2 else "cfpb", "td", DAY, None, f"s{i:02d}" if i else None) for i, s in enumerate(levels)]
    assigned = clusters.assign_clusters(complaints(spark, rows))
    assert complaint_marts.complaint_clusters(assigned).count() == 10
    assert complaint_marts.complaint_clusters(assigned, literal_join=True).count() == 30
    by_priority = {r.cluster_priority: r for r in clusters.cluster_summary(assigned).collect()}
    assert {p: r.complaint_count for p, r in by_priority.items()} == {2: 3, 5: 3, 6: 4}
    assert by_priority[2].common_sources == ["s01", "s02"] and by_priority[6].avg_severity_score == 0


def stats(spark, days, count=1, name="atm", priority=6):
    rows = [(DAY + dt.timedelta(d), name, "text", priority, count, 0.5, 1, 0, []) for d in days]
    return spark.createDataFrame(rows, (
        "complaint_date date, cluster_name string, cluster_description string, cluster_priority int, "
        "daily_complaint_count bigint, avg_severity_score double, reddit_count bigint, cfpb_count bigint, "
        "sample_complaints array<struct<complaint_id:string,source_type:string,complaint_preview:string,severity_level:string,source_detail:string>>"))


@pytest.mark.parametrize("days, want, balanced", [
    (14, "increasing", "stable"), (30, "stable", "stable"), (6, "insufficient_data", "insufficient_data"),
])
def test_trend_direction(spark, days, want, balanced):
    rows = stats(spark, range(days))
    assert clusters.cluster_trend_summary(rows).collect()[0].trend_direction == want
    assert clusters.cluster_trend_summary(rows, TrendSplit(balanced=True)).collect()[0].trend_direction == balanced


def test_trend_falls(spark):
    rows = stats(spark, range(20), 10).unionByName(stats(spark, range(20, 27), 1))
    row = clusters.cluster_trend_summary(rows).collect()[0]
    assert row.trend_direction == "decreasing" and len(row.recent_daily_samples) == 7
    assert row.recent_daily_samples[0].complaint_date == DAY + dt.timedelta(26)


def test_daily_trends_and_summary(spark):
    rows = stats(spark, [0, 1, 7], 4).unionByName(stats(spark, [0], 9, "card", 1)).unionByName(stats(spark, [0], 2, "card", 2))
    out = {(r.complaint_date, r.cluster_name, r.cluster_priority): r for r in clusters.daily_complaint_trends(rows).collect()}
    first = out[DAY, "card", 1]
    assert (first.total_daily_complaints, first.daily_active_clusters, first.weekly_complaint_count) == (15, 2, 11)
    assert [c.daily_complaint_count for c in first.daily_cluster_ranking] == [9, 4, 2]
    assert (first.day_of_week, first.day_name, first.week_start) == (2, "Monday", DAY)
    atm = out[DAY, "atm", 6]
    assert (atm.weekly_complaint_count, atm.days_active_in_week) == (8, 2)
    report = clusters.dashboard_summary(clusters.daily_complaint_trends(rows), str(DAY + dt.timedelta(7))).collect()
    assert [r.report_type for r in report] == ["cluster_summary"] * 3 + ["daily_summary"] * 3
    assert [r.cluster_priority for r in report[:3]] == [1, 2, 6]
    assert [r.daily_total_complaints for r in report[3:]] == [4, 4, 15]


def test_samples_are_the_gravest_and_longest(spark):
    rows = [(f"c{i}", "the atm" + "x" * i, "high" if i == 0 else "low", "cfpb", "td", DAY, None, "p") for i in range(8)]
    rows = [r[:1] + (r[1].replace("atmx", "atm x"),) + r[2:] for r in rows]
    one = {r.cluster_priority: r for r in complaint_marts.daily_stats(clusters.assign_clusters(complaints(spark, rows))).collect()}
    assert [s.complaint_id for s in one[6].sample_complaints] == ["c7", "c6", "c5", "c4", "c3"]
    assert one[6].daily_complaint_count == 7 and one[2].daily_complaint_count == 1


# --------------------------------------------- only what is shown is staged
def test_clusters_of_named_columns(spark, monkeypatch):
    rows = [(str(i), t, s, "cfpb" if i % 3 else "reddit", "td", DAY, None, f"s{i % 4}") for i, (t, s, _, _) in enumerate(CASES)]
    assigned = clusters.assign_clusters(complaints(spark, rows + rows[:2] + [(None, None, None, None, None, None, None, None)]))
    staged = []
    keep = complaint_marts.stage
    monkeypatch.setattr(complaint_marts, "stage", lambda df, name: staged.append(df.columns) or keep(df, name))
    shown = ("complaint_id", "cluster_name", "cluster_priority")
    for literal in (False, True):
        whole = complaint_marts.complaint_clusters(assigned, literal)
        some = complaint_marts.complaint_clusters(assigned, literal, columns=shown)
        names = [c for c in whole.columns if c in shown or (c.startswith("cluster_") and c != "cluster_description")]
        assert sorted(map(str, some.select(names).collect())) == sorted(map(str, whole.select(names).collect()))
    assert "complaint_text" in staged[0] and "cleaned_text" in staged[0]
    assert not {"complaint_text", "cleaned_text", "feature_vector"} & {*staged[1], *staged[3]}
