import json

import pytest
from pyspark.sql import functions as F

from parley.functions.responses import candidates, check_responses, clean_response
from parley.functions.rules import differs_from_default, rule_insight
from parley.plans import scoring
from parley.plans.dashboard import any_action, category_coverage, outcome_flow
from parley.schemas import CATEGORIES

OK = {"primaryTopics": ["a"]}


def nested(**categories):
    return json.dumps({"callAnalysis": OK, **categories})


VALID = {
    "empty object": "{}",
    "topics empty": '{"callAnalysis":{"primaryTopics":[]}}',
    "topics null": '{"callAnalysis":{"primaryTopics":null}}',
    "topics text": '{"callAnalysis":{"primaryTopics":"x"}}',
    "budget as text": nested(budgetAndBidding={"dailyBudget": "500"}),
    "budget as number": nested(budgetAndBidding={"dailyBudget": 12.5, "monthlyBudget": 3}),
    "flag as word": nested(seasonalContext={"seasonalPressure": "Yes"}),
    "flag as one": nested(seasonalContext={"seasonalPressure": 1}),
    "unknown key": nested(more=[1]),
    "null enum": nested(campaignStructure={"primaryCampaignType": None}),
    "fenced": '```json\n{"sentiment":"positive"}\n```',
    "prose": 'Sure: {"sentiment":"positive"} bye',
    "object in list": '[{"sentiment":"negative"}]',
    "program lists": nested(complaintAnalysis={"programSpecificComplaints": {"SD": ["x"], "SB": []}}),
}
INVALID = {
    "empty": "",
    "null": None,
    "no analysis fields": '{"callAnalysis":{}}',
    "analysis null": '{"callAnalysis":null}',
    "topics of numbers": '{"callAnalysis":{"primaryTopics":[1,2]}}',
    "topics with null": '{"callAnalysis":{"primaryTopics":["a",null]}}',
    "enum case": '{"callAnalysis":{"primaryTopics":["a"],"overallSentiment":"Positive"}}',
    "list null": nested(actionItems={"nextSteps": None}),
    "budget word": nested(budgetAndBidding={"dailyBudget": "much"}),
    "flag two": nested(seasonalContext={"seasonalPressure": 2}),
    "flag null": nested(seasonalContext={"seasonalPressure": None}),
    "flag word": nested(seasonalContext={"seasonalPressure": "maybe"}),
    "category null": nested(seasonalContext=None),
    "category list": nested(seasonalContext=[]),
    "text as number": nested(callAnalysis={"primaryTopics": ["a"], "currentIssue": 5}),
    "program list": nested(complaintAnalysis={"programSpecificComplaints": {"SP": [1]}}),
    "program null": nested(complaintAnalysis={"programSpecificComplaints": None}),
    "list": "[1,2]",
    "truncated": '{"callAnalysis":{"primaryTopics":["a"]',
    "flat enum": '{"sentiment":"great"}',
}


@pytest.fixture(scope="module")
def checked(spark):
    cases = {**VALID, **INVALID}
    df = spark.createDataFrame(list(cases.items()), "name string, raw string")
    return {r["name"]: r for r in check_responses(df, "raw").collect()}


@pytest.mark.parametrize("name", VALID)
def test_valid(checked, name):
    assert checked[name].valid and checked[name].reason is None and checked[name].insight is not None


@pytest.mark.parametrize("name", INVALID)
def test_invalid(checked, name):
    assert not checked[name].valid and checked[name].reason and checked[name].insight is None


def test_typed_values_and_defaults(checked):
    assert checked["budget as text"].insight.budgetAndBidding.dailyBudget == 500.0
    assert checked["flag as word"].insight.seasonalContext.seasonalPressure is True
    assert checked["flag as one"].insight.seasonalContext.seasonalPressure is True
    call = checked["topics empty"].insight.callAnalysis
    assert (call.primaryTopics, call.overallSentiment, call.urgencyLevel) == (["general"], "neutral", None)
    flat = checked["empty object"]
    call = flat.insight.callAnalysis
    assert flat.coerced and (call.primaryTopics, call.overallSentiment, call.urgencyLevel) == (["general"], "neutral", "low")
    assert not checked["topics text"].coerced and checked["topics text"].insight.callAnalysis.primaryTopics == ["x"]
    assert checked["program lists"].insight.complaintAnalysis.programSpecificComplaints.SD == ["x"]


def test_cleaning_and_candidates(spark):
    df = spark.createDataFrame([('  ```\n{"a":1}\n```  ',), ("x {1} y",), ("none",)], "raw string")
    got = df.select(clean_response(F.col("raw")).alias("c"), candidates(F.col("raw")).alias("k")).collect()
    assert [r.c for r in got] == ['{"a":1}', "x {1} y", "none"]
    assert [r.k for r in got] == [['{"a":1}', '{"a":1}'], ["x {1} y", "{1}"], ["none"]]


def test_rule_insight_is_a_valid_answer(spark):
    df = spark.createDataFrame([("Our ROAS budget issue",), ("",)], "t string")
    answers = df.select(F.to_json(rule_insight(F.col("t"))).alias("raw"), rule_insight(F.col("t")).alias("i"))
    for row in check_responses(answers, "raw").collect():
        assert row.valid and row.insight == row.i


def test_defaults_do_not_count_as_coverage(spark):
    df = check_responses(spark.createDataFrame([("{}",)], "raw string"), "raw")
    row = df.select(*[differs_from_default(c, F.col("insight")[c]).alias(c) for c in CATEGORIES]).first()
    assert [c for c in CATEGORIES if row[c]] == ["callAnalysis"]


def test_rule_insight_fills_what_no_keyword_decides(spark):
    df = spark.createDataFrame([("Our ROAS is great",), ("",)], "t string").select(rule_insight(F.col("t")).alias("i"))
    good, blank = (r.i for r in df.collect())
    assert good.callAnalysis.primaryTopics == ["Performance Metrics", "Campaign Structure"]
    assert blank.callAnalysis.primaryTopics == ["Budget Optimization", "Campaign Structure"]
    assert (good.performanceMetricsSentiment.advertiserPerception, blank.performanceMetricsSentiment.advertiserPerception) == ("positive", "neutral")
    assert blank.actionItems.immediateActions == ["review_bids", "check_targeting"] and blank.callAnalysis.resolutionType == "partial"
    filled = df.select(*[differs_from_default(c, F.col("i")[c]).alias(c) for c in CATEGORIES]).collect()[1]
    assert [c for c in CATEGORIES if not filled[c]] == ["budgetAndBidding", "seasonalContext"]


def test_coverage_of_rule_insights(spark):
    df = spark.createDataFrame([("budget",), ("",), (None,), ("ROAS",)], "t string").select(rule_insight(F.col("t")).alias("insight"))
    found = {r.category: r.calls for r in category_coverage(df).collect()}
    assert found == {c: {"budgetAndBidding": 1, "seasonalContext": 0}.get(c, 4) for c in CATEGORIES}


def test_outcome_of_rule_insights(spark):
    df = spark.createDataFrame([("great",), ("an issue",), ("",), (None,)], "t string").select(rule_insight(F.col("t")).alias("i"))
    flow = outcome_flow(df, F.col("i.callAnalysis.overallSentiment"), F.col("i.callAnalysis.resolutionType"), any_action(F.col("i")))
    assert sorted(map(tuple, flow.collect())) == [("negative", "actioned", 1), ("neutral", "actioned", 2), ("positive", "actioned", 1)]


def test_summary_of_rule_insights_counts_both_topics(spark):
    df = scoring.score_by_rules(spark.createDataFrame([("ROAS",), ("",), ("",)], "transcript string"))
    assert scoring.batch_summary(df).first().top_topics == ["Campaign Structure", "Budget Optimization", "Performance Metrics"]
