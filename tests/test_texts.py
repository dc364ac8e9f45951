import pytest
from pyspark.sql import functions as F

from pulsemart.functions import parsing, text as T
from pulsemart.functions.tokens import tokens
from pulsemart.operators import enrich, features
from pulsemart.settings import EnrichSettings, TWITTER_TONE

SERVICE = "Their customer service was terrible, and the worst of it is the queue"
APP = "I love what the mobile app does"


def scored(spark, *texts, cfg=EnrichSettings()):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    out = enrich.enrich(df, F.lit("2024-01-01").cast("timestamp"), cfg=cfg)
    return out.orderBy("i").collect()


def test_enrichment_counts_words_and_topics(spark):
    service, app, short, empty = scored(spark, SERVICE, APP, "ninechars", None)
    assert service.sentiment == pytest.approx(-0.4) and service.topics == ["customer_service"]
    assert app.sentiment == pytest.approx(0.2) and app.topics == ["mobile_app"]
    assert (short.sentiment, short.topics, short.nlp_confidence) == (0.0, [], 0.0)
    assert (empty.sentiment, empty.nlp_confidence) == (0.0, 0.0)
    assert service.nlp_confidence == 0.6 and service.nlp_model == "lexicon"


def test_enrichment_limits(spark):
    grave, tie, many = scored(
        spark, "fraud and a scam with stolen money", "good but also bad service", "fees overdraft fraud atm outage ux here"
    )
    assert grave.severity == 0.8
    assert tie.sentiment == 0.0
    assert many.topics == ["atm", "fees", "overdraft"]


def test_scoring_text_drops_links_and_keeps_the_rest(values):
    out = values(T.scoring_text(F.col("text")), ["see  https://a.b/c?d=1  now\n\tplease wait", "w " * 5000 + "end"])
    assert out == ["see now please wait", "w " * 5000 + "end"]


def test_chosen_text(values):
    expr = enrich.chosen_text(F.col("title"), F.col("body"), F.col("text"))
    rows = [("T", "B", "X"), ("", "B", None), (None, "B", "X"), (None, None, None), ("T", None, None)]
    assert values(expr, rows, "title string, body string, text string") == ["T\n\nB", "B", "X", "", "T\n\n"]


def test_response_parse_clamps_and_defaults(values):
    answers = [
        'noise {"sentiment": 3, "severity": -1, "topics": ["a","b","c","d"]} tail', "no braces", None,
        '{"sentiment": -0.25, "language": "fr", "confidence": 7}', "{broken",
    ]
    full, none, null, partial, broken = values(enrich.parse_response(F.col("text")), answers)
    assert tuple(full) == (1.0, 0.0, ["a", "b", "c"], "en", 0.5)
    for row in (none, null, broken):
        assert tuple(row) == (0.0, 0.0, [], "en", 0.0)
    assert tuple(partial) == (-0.25, 0.0, [], "fr", 1.0)


def test_plugged_scorer_failure_is_recorded(spark):
    def failing(texts):
        raise ValueError("model is down")

    df = spark.createDataFrame([(1, "some text here")], "i int, text string")
    row = enrich.score_with(df, failing, "m", "v9", F.lit("2024-01-01").cast("timestamp")).collect()[0]
    assert (row.sentiment, row.topics, row.nlp_model, row.nlp_error) == (0.0, [], "none", "model is down")


def test_tone_is_positive_first_and_whole_word(values):
    texts = ["great but awful", "awful", "greatness", "plain", "badé"]
    assert values(T.tone(F.lower("text"), TWITTER_TONE), texts) == [0.5, -0.5, 0.0, 0.0, -0.5]


def test_whole_words_ignore_plurals_and_accents_are_edges(values):
    texts = ["too many fees", "one fee.", "caféfee", "x_fee", "customer service!"]
    words = ("fee", "customer service")
    assert values(T.has_word(F.lower("text"), words), texts) == [False, True, True, False, True]


def test_text_statistics(values):
    assert values(T.space_pieces(F.col("text")), ["a  b ", "one"]) == [4, 1]
    assert values(T.sentence_marks(F.col("text")), ["a. b! c?", "none"]) == [3, 0]
    assert values(T.alnum_only(F.lower("text")), ["  Café, OK!  (2x)\n"]) == ["caf ok 2x"]


def test_redaction(values):
    texts = ["mail a.b@c.org or 555-123-4567", "ssn 123-45-6789 card 4111 1111 1111 1111"]
    assert values(T.redact(F.col("text")), texts) == ["mail [EMAIL] or [PHONE]", "ssn [SSN] card [CARD]"]


def test_tokens_drop_stop_words_and_plurals(values):
    out = values(tokens(F.col("text")), ["The Banks' fees, policies and boxes of glass", "Étés"])
    assert out == [["bank", "fee", "policy", "boxe", "glass"], ["été"]]


def test_features_match_the_word_lists(spark):
    df = spark.createDataFrame(
        [("1", "My checking ACCOUNT has an error. I can’t cope!", "low")], "complaint_id string, complaint_text string, severity_level string"
    ).withColumns(
        {"source_type": F.lit("cfpb"), "brand_id": F.lit("td"), "complaint_date": F.lit("2024-01-01").cast("date"),
         "topics": F.array().cast("array<string>"), "source_detail": F.lit("x")}
    )
    row = features.text_features(df).collect()[0]
    assert row.has_account_terms == 1 and row.has_error_terms == 1 and row.has_inability_terms == 1
    assert row.feature_vector == "1,0,0,0,0,0,0,1,0,0,0,0,1,0" and row.feature_score == 3


def test_short_us_dates(values):
    out = values(parsing.short_us_date(F.col("text")), ["10/05/25", "1/2/69", "12/31/68", "", None, "2025-01-01", "13/45/20"])
    assert [str(d) if d else None for d in out] == ["2025-10-05", "1969-01-02", "2068-12-31", None, None, None, None]


def test_approval_share(values):
    assert values(parsing.approval_share(F.col("text")), ["0.8", "80", "150", "x", None, "-1", "1"]) == [0.8, 0.8, None, None, None, None, 1.0]


def test_json_members(values):
    doc = '{"a": "x", "n": "12", "d": 3.0, "o": {"k": 1}, "l": [1]}'
    for name, want in (("a", "x"), ("o", None), ("l", None), ("zz", None)):
        assert values(parsing.json_text(F.col("text"), name), [doc]) == [want]
    assert values(parsing.json_whole(F.col("text"), "n"), [doc]) == [12]
    assert values(parsing.json_whole(F.col("text"), "d"), [doc]) == [3]
    assert values(parsing.json_whole(F.col("text"), "a"), [doc]) == [None]
