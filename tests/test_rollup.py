"""The rollup of one entity with free-text topics."""

from collections import Counter

from pyspark.sql import functions as F

from parley.plans.rollup import concern_lists, entity_concerns, rollup

SCHEMA = """advertiser_id string, nlp_features struct<sentiment_score: double, sentiment_label: string,
    advanced_analysis: struct<call_analysis: struct<primary_topics: array<string>>, complaint_analysis: struct<complaint_keywords: array<string>>>>"""


def features(spark, n):
    rows = []
    for i in range(n):
        topics = [f"free text number {i}", "Shared"] + (["our ROAS Optimization talk"] if i == 7 else [])
        rows.append(("a", (-0.5, "negative", ((topics,), (["pain"] if i % 2 else None,)))))
    rows.append((None, (0.5, "positive", (([],), (None,)))))
    return spark.createDataFrame(rows, SCHEMA)


def test_free_text_topics_of_one_entity(spark):
    rows = {r.entity_id: r for r in rollup(features(spark, 3000), "2024-01-31").collect()}
    a = rows["a"]
    assert (a.call_count, a.concern_count, a.sentiment_label, a.sentiment_counts.negative) == (3000, 3003, "negative", 3000)
    assert [s.split()[0] for s in a.improvement_suggestions] == ["Switch", "Schedule", "Review"]
    assert (rows["unknown"].call_count, rows["unknown"].concern_count) == (1, 0)
    assert "concerns" not in a.asDict()


def test_no_list_is_built_per_entity(spark):
    plan = rollup(features(spark, 10), "2024-01-31")._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "collect_set" not in plan and "partial_" in plan


def test_concerns_in_long_form(spark):
    long = entity_concerns(features(spark, 20))
    want = Counter({("a", "Shared"): 20, ("a", "pain"): 10, ("a", "our ROAS Optimization talk"): 1, **{("a", f"free text number {i}"): 1 for i in range(20)}})
    assert {(r.entity_id, r.concern): r.mentions for r in long.collect()} == want
    assert concern_lists(long, 2).select(F.array_join("concerns", "|")).first()[0] == "Shared|pain"


def test_rollup_with_every_concern(spark):
    rows = {r.entity_id: r for r in rollup(features(spark, 20), "2024-01-31", lists=True).collect()}
    assert rows["a"].concerns == sorted({"Shared", "pain", "our ROAS Optimization talk", *[f"free text number {i}" for i in range(20)]})
    assert len(rows["a"].concerns) == rows["a"].concern_count and rows["unknown"].concerns == []
