"""The insights layer on a partitioned catalog table, and scoring by batches."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from checks.responses import CASES
from parley.functions.answers import problem
from parley.functions.responses import check_responses
from parley.plans import insights, reports, scoring

CALLS = "conversation_id string, advertiser_id string, call_date date, transcript string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    """A table of three months with one call a day, published by rules."""
    start = dt.date(2024, 1, 1)
    rows = [(f"c{i}", f"a{i % 5}", start + dt.timedelta(days=i), "a great roas budget call" if i % 3 else "issue with google") for i in range(91)]
    calls = spark.createDataFrame(rows, CALLS)
    out = str(tmp_path_factory.mktemp("layer"))
    insights.run_insights(calls, "insights_of_tests", out, "2024-04-01")
    return calls, "insights_of_tests", out


@pytest.mark.parametrize("name", reports.REPORTS)
def test_reports_read_the_partitions_they_name(spark, published, name):
    monthly = ":month" in reports.REPORTS[name]
    report = reports.run_report(spark, name, published[1], 2024, 2 if monthly else None)
    plan = plan_of(report)
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    assert scans and all("PartitionFilters: [isnotnull(year" in line and "= 2024)" in line for line in scans)
    assert all(("= 2)" in line) == monthly for line in scans)
    assert "transcript" not in plan and report.count() > 0


def test_latest_day_comes_from_partition_values(spark, published):
    latest = reports.latest_partition(spark.table(published[1]), 2024, 2)
    scans = [line for line in plan_of(latest).split("\n") if "FileScan" in line]
    assert scans and all("ReadSchema: struct<>" in line and "PartitionFilters: [isnotnull(year" in line for line in scans)
    assert latest.first().last_day == dt.date(2024, 2, 29)


def test_a_day_published_again_replaces_itself(spark, published):
    calls, table, out = published
    before = spark.table(table).count()
    again = calls.where("call_date = DATE '2024-02-10'").withColumn("transcript", F.lit("a problem"))
    insights.run_insights(again, table, out, "2024-04-02")
    rows = spark.table(table)
    assert rows.count() == before == 91
    assert rows.where("year = 2024 AND month = 2 AND day = 10").first().callanalysis_overallsentiment == "negative"
    later = calls.limit(1).withColumn("call_date", F.lit(dt.date(2025, 1, 1)))
    insights.run_insights(later, table, out, "2024-04-03")
    assert spark.table(table).where("year = 2025").count() == 1


def scorer_into(folder):
    """A scorer that leaves a line for each batch it is called with."""

    def score(prompts):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            json.dump(prompts, f)
        out = []
        for p in prompts:
            case = p.rsplit("Conversation:\n", 1)[1].split()[0]
            again = "<previous_response>" in p
            out.append(
                {
                    "good": '{"sentiment":"positive"}',
                    "late": '{"sentiment":"positive"}' if again else "no JSON",
                    "never": '{"callAnalysis":{}}',
                    "down": ValueError("down"),
                    "none": None,
                }[case]
            )
        return out

    return score


def test_open_prompts_alone_are_asked_again_in_batches(spark, tmp_path):
    cases = ["good", "late", "never", "down", "none"] * 8
    calls = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "id int, transcript string").coalesce(1)
    scored = scoring.score_calls(calls, scorer_into(tmp_path), max_attempts=3, prompts_sent=20)
    assert plan_of(scored).count("ArrowEvalPython") == 1 and "BatchEvalPython" not in plan_of(scored)
    rows = {r.id: r for r in scored.collect()}
    want = {"good": (1, True, None), "late": (2, True, None), "never": (3, False, None), "down": (3, False, "down"), "none": (3, False, "no answer")}
    assert all((rows[i].attempts, rows[i].success, rows[i].last_exception) == want[c] for i, c in enumerate(cases))
    assert all((r.insight is not None) == r.success == (r.error == "") == (not r.fallback_used) for r in rows.values())
    sent = [json.loads(f.read_text()) for f in tmp_path.iterdir()]
    # two batches of twenty, three rounds each: all, all but the good ones, then those without an answer yet
    assert sorted(len(s) for s in sent) == [12, 12, 16, 16, 20, 20]
    again = [p for s in sent for p in s if "<previous_response>" in p]
    assert len(again) == 8 + 2 * 8 and all("no JSON" in p or '{"callAnalysis":{}}' in p for p in again)


def test_a_scorer_that_fails_as_a_whole_loses_no_row(spark):
    def broken(prompts):
        raise ConnectionError("no service")

    calls = spark.createDataFrame([(i, "x") for i in range(10)], "id int, transcript string")
    rows = scoring.score_calls(calls, broken, max_attempts=2).collect()
    assert len(rows) == 10 and all((r.success, r.attempts, r.last_exception) == (False, 2, "no service") for r in rows)
    short = scoring.score_calls(calls, lambda prompts: ["{}"], max_attempts=1).collect()
    assert sum(r.success for r in short) == 0 or len(short) == 10


def test_the_stored_score_calls_the_scorer_once(spark, tmp_path):
    (tmp_path / "seen").mkdir()
    calls = spark.createDataFrame([(i, "good") for i in range(10)], "id int, transcript string").coalesce(1)
    for _ in range(2):
        scored = scoring.score_to_table(calls, str(tmp_path / "t"), "2024-01-01", scorer_into(tmp_path / "seen"), ["id"])
        assert scored.count() == 10 and scored.where("success").count() == 10
    assert len(list((tmp_path / "seen").iterdir())) == 2 and "transcript" not in scored.columns


ODD = [
    None, "{", "[]", '{"a":1}', '{"sentiment":"Positive"}', '{"sentiment":null}', '{"key_topics":null}', '{"key_topics":"x"}', '{"key_topics":[1]}',
    '{"key_topics":0}', '{"key_topics":{}}', '{"key_topics":{"a":1}}', '{"key_topics":false}', '{"key_topics":true}', '{"primary_topics":["a"],"urgency":"low"}',
    '{"callAnalysis":null}', '{"callAnalysis":[]}', '{"callAnalysis":{"primaryTopics":[null]}}', '{"callAnalysis":{"primaryTopics":["a"]},"seasonalContext":null}',
    '{"budgetAndBidding":{"dailyBudget":"5e2"}}', '{"budgetAndBidding":{"dailyBudget":"x"}}', '{"budgetAndBidding":{"dailyBudget":true}}', '{"budgetAndBidding":{"dailyBudget":[]}}',
    '{"seasonalContext":{"seasonalPressure":"yes"}}', '{"seasonalContext":{"seasonalPressure":500}}', '{"seasonalContext":{"seasonalPressure":1.0}}', '{"seasonalContext":{"seasonalPressure":null}}',
    '{"campaignScale":{"scalePerception":"bad"}}', '{"campaignScale":{"targetingRestrictions":"a"}}', '{"complaintAnalysis":{"programSpecificComplaints":null}}',
    '{"complaintAnalysis":{"programSpecificComplaints":{"SD":["a"]}}}', '{"complaintAnalysis":{"programSpecificComplaints":{"SD":"a"}}}', '{"a":1,"a":2}', '{"a":NaN}', '{"identificationMetrics":{"repName":5}}',
]


def test_the_tasks_check_is_that_of_the_columns(spark):
    raws = [raw for raw, *_ in CASES.values()] + ODD
    rows = check_responses(spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw string"), "raw").collect()
    assert {raws[r.i]: r.reason for r in rows} == {raw: problem(raw) for raw in raws}


def test_topics_of_an_order_are_counted_in_its_row(spark, sf):
    from checks.features import fea_topic_consolidation

    df = fea_topic_consolidation(spark, sf)
    plan = plan_of(df)
    # a set of texts per order and a second hash table over orders and topics before
    assert "collect_set" not in plan and "ObjectHashAggregate" not in plan and plan.count("keys=[l_orderkey") == plan.count("HashAggregate(keys")
    assert df.count() == df.select("l_orderkey", "topic").distinct().count()


def test_days_are_published_from_narrow_rows(spark, sf, tmp_path):
    from checks.views import _orders_with_bits, insight_records

    rows, day = _orders_with_bits(spark, sf), F.col("o_orderdate").cast("date")
    keep, tables = ["conversation_id", "advertiser_id"], [f"t_{uuid.uuid4().hex[:8]}" for _ in range(2)]
    insights.publish_insights(insight_records(rows), tables[0], str(tmp_path / "wide"), day, keep=keep)
    insights.publish_insights(rows, tables[1], str(tmp_path / "narrow"), day, keep=keep, derive=insight_records)
    wide, narrow = (spark.table(t) for t in tables)
    assert wide.columns == narrow.columns and wide.count() == narrow.count() == 1500
    assert wide.exceptAll(narrow).count() == narrow.exceptAll(wide).count() == 0
    # all that is shuffled of an order; nested insights of 66 columns before
    assert rows.columns == ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "places", "words"]
