"""Records whose fields are spelled in several ways."""

from pyspark.sql import functions as F

from parley.functions.layouts import snake, unified
from parley.plans.flows import raw_mentions


def test_names():
    names = {"primaryTopics": "primary_topics", "primary_topics": "primary_topics", "SD": "sd", "roasSentimentAdvertiser": "roas_sentiment_advertiser"}
    assert {n: snake(n) for n in [*names, "HTMLText", "a1B"]} == {**names, "HTMLText": "html_text", "a1B": "a1_b"}


def test_the_first_filled_spelling_counts_at_any_depth(spark):
    schema = "r struct<aB: string, a_b: string, inDeep: struct<xY: array<string>, z: int>, in_deep: struct<x_y: string, z: int>>"
    rows = [(("1", "2", (["p"], None), ("q", 5)),), (("", "2", ([], 3), ("q", 5)),), ((None, None, None, ("", None)),), (None,)]
    df = spark.createDataFrame(rows, schema)
    value, dtype = unified(F.col("r"), df.schema["r"].dataType)
    assert dtype.simpleString() == "struct<a_b:string,in_deep:struct<x_y:array<string>,z:int>>"
    got = [r.v and r.v.asDict(True) for r in df.select(value.alias("v")).collect()]
    assert got == [
        {"a_b": "1", "in_deep": {"x_y": ["p"], "z": 5}},
        {"a_b": "2", "in_deep": {"x_y": ["q"], "z": 3}},
        {"a_b": None, "in_deep": {"x_y": None, "z": None}},
        None,
    ]


def test_mixed_spellings_in_one_analysis(spark):
    schema = """processed_insights struct<callAnalysis: struct<overallSentiment: string, primaryTopics: array<string>, primary_topics: array<string>>>,
        nlp_features struct<advanced_analysis: struct<call_analysis: struct<overall_sentiment: string, primaryTopics: string>>>, sentiment string"""
    rows = [
        ((("good", [], ["t1", "t2"]),), ((("bad", "t9"),),), None),  # label in one spelling, topics in the other
        ((("good", ["t3"], ["t4"]),), None, None),
        (((None, None, None),), ((("bad", "t5"),),), None),  # an analysis without anything in it
        (None, (((None, "t6"),),), "poor"),
        (None, (((None, ""),),), "poor"),
    ]
    got = raw_mentions(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.topic, r.label, r.own) for r in got) == [
        ("t1", "good", None), ("t2", "good", None), ("t3", "good", None), ("t5", "bad", None), ("t6", None, "poor")
    ]
