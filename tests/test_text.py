import pytest
from pyspark.sql import functions as F

from parley.functions import prompts as P
from parley.functions import text as X
from parley.functions import vocabulary as V
from parley.plans.features import feature_record


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr.alias("y")).first()["y"]


@pytest.mark.parametrize(
    "raw, default, strict",
    [
        ("dissatisfied", "positive", "negative"),
        ("Very GOOD", "positive", "positive"),
        ("mixed", "neutral", "neutral"),
        ("bad", "negative", "negative"),
        ("whatever", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_sentiment_labels(spark, raw, default, strict):
    assert one(spark, X.normalize_sentiment(F.col("x")), raw) == default
    assert one(spark, X.normalize_sentiment(F.col("x"), strict=True), raw) == strict


@pytest.mark.parametrize(
    "topic, name",
    [
        ("ad spend", "Sponsored Products"),
        ("cpc_reduction", "Performance Metrics"),
        ("competitor_analysis", "Competitor Analysis"),
        ("budget_management", "Budget Optimization"),
        ("  Reporting_Analytics ", "Reporting"),
        ("x" * 60, "X" + "x" * 59),
    ],
)
def test_topic_consolidation(spark, topic, name):
    assert one(spark, X.consolidate_topic(F.col("x")), topic) == name


@pytest.mark.parametrize("text, n", [("a b", 2), ("a\x1cb", 2), ("  a  b ", 2), ("", 0), (None, 0), ("a\n\tb c", 3)])
def test_word_count(spark, text, n):
    assert one(spark, X.word_count(F.col("x")), text) == n


def features(spark, text, **kw):
    df = spark.createDataFrame([("c1", text)], "conversation_id string, transcript string")
    return feature_record(df, 0, **kw).first()


def test_tokens_keep_punctuation_and_flags_are_substrings(spark):
    row = features(spark, "great! metadata")
    assert row.nlp_features.sentiment_label == "neutral"
    assert row.business_features.competitor_mentioned
    assert not features(spark, "great! metadata", word_boundary=True).business_features.competitor_mentioned


@pytest.mark.parametrize(
    "text, score, label",
    [("great happy issue", 0.3333, "positive"), ("nothing", 0.0, "neutral"), ("issue fail great", -0.3333, "negative")],
)
def test_score(spark, text, score, label):
    row = features(spark, text).nlp_features
    assert (row.sentiment_score, row.sentiment_label) == (score, label)


@pytest.mark.parametrize("n, level", [(0, "low"), (1, "low"), (2, "medium"), (3, "medium"), (4, "high")])
def test_pressure(spark, n, level):
    a = features(spark, "issue " * n).nlp_features.advanced_analysis
    assert a.call_analysis.urgency == a.complaint_analysis.severity == level
    assert a.call_analysis.follow_up_required == (n > 2)


def test_missing_columns_take_defaults(spark):
    row = feature_record(spark.createDataFrame([(1,)], "other int"), 5).first()
    assert row.metadata.asDict() == {
        "conversation_id": "",
        "duration_seconds": 0,
        "participant_count": 0,
        "word_count": 0,
    }
    assert row.nlp_features.advanced_analysis.call_analysis.primary_topics == ["general"]
    assert row.nlp_features.advanced_analysis.complaint_analysis.complaint_keywords == []
    assert row.processing_timestamp == 5


@pytest.mark.parametrize(
    "text, decoded",
    [
        ("&amp;lt;", "&lt;"),
        ("ROAS &gt; 3.0 &amp; CPC &lt; 2.0", "ROAS > 3.0 & CPC < 2.0"),
        ("caf&eacute; &#8364; &amp;amp;", "café € &amp;"),
        ("a & b", "a & b"),
        ("&ampx &copy &amp;#39;", "&x © &#39;"),
        ("plain", "plain"),
        (None, None),
    ],
)
def test_entity_decoding(spark, text, decoded):
    assert one(spark, X.decode_entities(F.col("x")), text) == decoded


def test_segments_alternate_speakers_by_position(spark):
    got = one(spark, X.segments(F.col("x")), "One. . Three. Four.")
    assert [(s.pos, s.speaker, s.text) for s in got] == [(0, "rep", "One."), (2, "rep", "Three."), (3, "customer", "Four..")]


def test_prompts_hold_the_text_and_name_every_category(spark):
    text = one(spark, P.full_prompt(F.col("x")), "y" * 5000)
    assert text.endswith("Conversation:\n" + "y" * 5000)
    assert all(f"--- {name} ---" in text for name in P.INSIGHT_FIELDS)
    assert one(spark, F.char_length(P.short_prompt(F.col("x"))), "y" * 5000) > 5000


def test_token_estimate(spark):
    assert one(spark, X.token_estimate(F.col("x")), "a " * 200) == 200
