"""Scorer answers: cleaning, checking, batch scoring and its summaries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.features import _any
from checks.registry import check
from checks.views import CALLS, calls, table
from parley.functions import responses as R
from parley.functions import vocabulary as V
from parley.functions.rules import derived_fields
from parley.plans import scoring as S
from parley.plans.insights import run_insights
from parley.settings import work_folder

FENCE = "```"
NESTED = (
    '{"callAnalysis":{"primaryTopics":["roas","budget"],"overallSentiment":"negative","urgencyLevel":"high","currentIssue":"@"},'
    '"budgetAndBidding":{"dailyBudget":"500"},"complaintAnalysis":{"complaintKeywords":["high_cpc"]},"extra":1}'
)
FLAT = '{"key_topics":["bids","@"],"sentiment":"positive","urgency":"medium"}'
# The priority of the order stands where the answers have @. Remainder of the order key -> (answer, valid, coerced, topics, sentiment, urgency).
CASES = {
    0: (NESTED, True, False, "roas|budget", "negative", "high"),
    1: (FLAT, True, True, "bids|@", "positive", "medium"),
    2: (f"{FENCE}json\n{FLAT}\n{FENCE}\n", True, True, "bids|@", "positive", "medium"),
    3: (f"Here is the answer: {NESTED} Done.", True, False, "roas|budget", "negative", "high"),
    4: ('{"callAnalysis":{"primaryTopics":["a"],"overallSentiment":"Positive"}}', False, False, None, None, None),
    5: ('{"callAnalysis":{"primaryTopics":["a"],"secondaryTopics":null}}', False, False, None, None, None),
    6: ("{}", True, True, "general", "neutral", "low"),
    7: ('{"callAnalysis":{"primaryTopics":["a"', False, False, None, None, None),
    8: ("", False, False, None, None, None),
    9: ("[1, 2, 3]", False, False, None, None, None),
    10: ('{"callAnalysis":{"primaryTopics":"one"}}', True, False, "one", "neutral", None),
    11: ('{"callAnalysis":{"primaryTopics":[]}}', True, False, "general", "neutral", None),
    12: ('{"callAnalysis":{}}', False, False, None, None, None),
}
N = len(CASES)


def _quote(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    return "'" + v.replace("'", "''") + "'"


def _case_sql(position: int) -> str:
    arms = " ".join(f"WHEN {k} THEN {_quote(v[position])}" for k, v in CASES.items())
    case = f"CASE o_orderkey % {N} {arms} END"
    return f"replace({case}, '@', o_orderpriority)" if position in (0, 3) else case


def _answers(spark, sf):
    raws = F.array(*[F.lit(v[0]) for v in CASES.values()])
    raw = F.element_at(raws, (F.col("o_orderkey") % N + 1).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", F.replace(raw, F.lit("@"), "o_orderpriority").alias("raw"))


_TRIM = r"regexp_replace(regexp_replace({x}, '^\s+', ''), '\s+$', '')"


@check(
    "val_clean_response",
    f"""WITH a AS (SELECT o_orderkey, {_case_sql(0)} AS raw FROM orders)
        SELECT o_orderkey, CASE WHEN starts_with(raw, '{FENCE}')
          THEN {_TRIM.format(x=f"replace(replace(raw, '{FENCE}json', ''), '{FENCE}', '')")} ELSE raw END AS cleaned FROM a""",
)
def val_clean_response(spark, sf):
    return _answers(spark, sf).select("o_orderkey", R.clean_response(F.col("raw")).alias("cleaned"))


@check(
    "val_candidates",
    f"""WITH a AS (SELECT o_orderkey, {_case_sql(0)} AS raw FROM orders)
        SELECT o_orderkey, CAST(CASE WHEN contains(raw, '{{') AND contains(raw, '}}') THEN 2 ELSE 1 END AS INT) AS n,
               CASE WHEN o_orderkey % {N} = 3 THEN replace(replace(raw, 'Here is the answer: ', ''), ' Done.', '') ELSE '' END AS braces
        FROM a""",
)
def val_candidates(spark, sf):
    c = R.candidates(F.col("raw"))
    return _answers(spark, sf).select(
        "o_orderkey",
        F.size(c).alias("n"),
        F.when(F.col("o_orderkey") % N == 3, F.element_at(c, -1)).otherwise("").alias("braces"),
    )


@check(
    "val_check",
    f"""SELECT o_orderkey, {_case_sql(1)} AS valid, {_case_sql(2)} AS coerced,
        CASE WHEN o_orderkey % {N} IN (7, 8, 9) THEN 'answer holds no JSON object'
             WHEN NOT {_case_sql(1)} THEN '{V.INVALID_REASON}' END AS reason FROM orders""",
)
def val_check(spark, sf):
    return R.check_responses(_answers(spark, sf), "raw").select("o_orderkey", "valid", "coerced", "reason")


@check(
    "val_insight",
    f"""SELECT o_orderkey, {_case_sql(3)} AS topics, {_case_sql(4)} AS sentiment, {_case_sql(5)} AS urgency,
        CASE WHEN o_orderkey % {N} IN (0, 3) THEN 500.0::DOUBLE ELSE 0.0 END AS budget,
        CASE WHEN o_orderkey % {N} IN (0, 3) THEN 'high_cpc' ELSE '' END AS complaints,
        o_orderkey % {N} IN (0, 3) AS pricing_mentioned,
        CASE WHEN o_orderkey % {N} IN (0, 3) THEN o_orderpriority ELSE '-' END AS issue
        FROM orders WHERE {_case_sql(1)}""",
)
def val_insight(spark, sf):
    good, _ = R.split_by_validity(R.check_responses(_answers(spark, sf), "raw"))
    d = derived_fields(F.col("insight"))
    return good.select(
        "o_orderkey",
        F.array_join(d["key_topics"], "|").alias("topics"),
        d["sentiment"].alias("sentiment"),
        d["urgency"].alias("urgency"),
        F.coalesce("insight.budgetAndBidding.dailyBudget", F.lit(0.0)).alias("budget"),
        F.array_join("insight.complaintAnalysis.complaintKeywords", "|").alias("complaints"),
        d["pricing_mentioned"].alias("pricing_mentioned"),
        F.coalesce("insight.callAnalysis.currentIssue", F.lit("-")).alias("issue"),
    )


@check("val_quarantine", f"SELECT o_orderkey, {_case_sql(0)} AS raw FROM orders WHERE NOT {_case_sql(1)}")
def val_quarantine(spark, sf):
    _, bad = R.split_by_validity(R.check_responses(_answers(spark, sf), "raw"))
    return bad.select("o_orderkey", "raw")


def _sample_scorer():
    """A scorer of batches that answers by the first word of each transcript, as a closure for the workers."""

    def answer(prompt: str) -> str | Exception:
        head = prompt.rsplit("Conversation:\n", 1)[1]
        retried = "<previous_response>" in prompt
        if head.startswith("case0 ") and not retried:
            return "no JSON here"
        if head.startswith("case1 "):
            return RuntimeError("service is down")
        if head.startswith("case2 "):
            return '{"callAnalysis":{}}'
        mood = "positive" if "great" in head else "negative"
        return '{"callAnalysis":{"primaryTopics":["t"],"overallSentiment":"%s","urgencyLevel":"high"}}' % mood

    return lambda prompts: [answer(p) for p in prompts]


def _numbered(spark, sf):
    case = F.concat(F.lit("case"), (F.col("o_orderkey") % 6).cast("string"), F.lit(" "), F.col("transcript"))
    return calls(spark, sf).withColumn("transcript", case)


def _scored(spark, sf):
    return S.score_calls(_numbered(spark, sf), _sample_scorer())


@check(
    "score_calls",
    f"""WITH {CALLS} SELECT o_orderkey, CAST(CASE o_orderkey % 6 WHEN 0 THEN 2 WHEN 1 THEN 4 WHEN 2 THEN 4 ELSE 1 END AS INT) AS attempts,
        o_orderkey % 6 NOT IN (1, 2) AS success,
        CASE WHEN o_orderkey % 6 IN (1, 2) THEN '{V.EXHAUSTED_REASON}' ELSE '' END AS error,
        CASE WHEN o_orderkey % 6 = 1 THEN 'service is down' ELSE '' END AS last_exception,
        o_orderkey % 6 IN (1, 2) AS fallback_used,
        CASE WHEN o_orderkey % 6 IN (1, 2) THEN '-' WHEN contains(transcript, 'great') THEN 'positive' ELSE 'negative' END AS sentiment
        FROM calls""",
)
def score_calls(spark, sf):
    return _scored(spark, sf).select(
        "o_orderkey",
        "attempts",
        "success",
        "error",
        F.coalesce("last_exception", F.lit("")).alias("last_exception"),
        "fallback_used",
        F.coalesce("insight.callAnalysis.overallSentiment", F.lit("-")).alias("sentiment"),
    )


@check(
    "score_default",
    f"""WITH {CALLS}, c AS (SELECT o_orderkey, lower(transcript) AS low FROM calls)
        SELECT o_orderkey, CAST(1 AS INT) AS attempts, 0.0::DOUBLE AS latency_seconds, true AS success, '' AS error, '-' AS last_exception,
          false AS fallback_used, CASE WHEN {_any('low', ['great', 'excellent', 'success', 'happy'])} THEN 'positive'
            WHEN {_any('low', ['issue', 'problem', 'frustrated', 'fail'])} THEN 'negative' ELSE 'neutral' END AS sentiment,
          CASE WHEN {_any('low', ['issue', 'problem', 'fail'])} THEN 'high' ELSE 'medium' END AS urgency FROM c""",
)
def score_default(spark, sf):
    """The full output of the default scorer; the labels are read from the response text."""
    return S.score_by_rules(calls(spark, sf)).select(
        "o_orderkey",
        "attempts",
        "latency_seconds",
        "success",
        "error",
        F.coalesce("last_exception", F.lit("-")).alias("last_exception"),
        "fallback_used",
        F.get_json_object("response", "$.callAnalysis.overallSentiment").alias("sentiment"),
        F.get_json_object("response", "$.callAnalysis.urgencyLevel").alias("urgency"),
    )


@check(
    "insights_run",
    f"""WITH {CALLS} SELECT CAST(o_orderdate AS DATE)::VARCHAR AS call_date, count(*) AS scored,
          count(*) FILTER (WHERE o_orderkey % 6 NOT IN (1, 2)) AS published,
          count(*) FILTER (WHERE o_orderkey % 6 NOT IN (1, 2) AND contains(transcript, 'great')) AS positive
        FROM calls JOIN orders USING (o_orderkey) WHERE year(o_orderdate) = 1997 AND month(o_orderdate) <= 3 GROUP BY 1""",
)
def insights_run(spark, sf):
    """A quarter's calls scored, published and read back by day; run twice, with the second run in place of the first."""
    name, folder = f"insights_{uuid.uuid4().hex[:12]}", work_folder(spark, "insights")
    days = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("call_date"))
    quarter = days.where("year(call_date) = 1997 AND month(call_date) <= 3")
    for _ in range(2):
        scored = run_insights(_numbered(spark, sf).join(quarter, "o_orderkey"), name, folder, "2024-01-31", _sample_scorer())
    day = F.make_date("year", "month", "day")
    good = F.count_if(F.col("callanalysis_overallsentiment") == "positive")
    found = spark.table(name).groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("published"), good.alias("positive"))
    all_calls = scored.groupBy("call_date").agg(F.count(F.lit(1)).alias("scored"))
    joined = all_calls.join(found, F.col("call_date") == F.col("day"), "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        F.col("call_date").cast("string").alias("call_date"),
        "scored",
        F.coalesce("published", zero).alias("published"),
        F.coalesce("positive", zero).alias("positive"),
    )


@check(
    "score_fallback",
    f"""SELECT o_orderkey, o_orderkey % 7 = 0 AS fallback_used,
        CASE WHEN o_orderkey % 7 = 0 THEN '{V.FALLBACK_RESPONSE}' ELSE {_case_sql(0)} END AS response FROM orders""",
)
def score_fallback(spark, sf):
    out = S.with_fallback(_answers(spark, sf), F.col("raw"), F.col("o_orderkey") % 7 == 0)
    return out.select("o_orderkey", "fallback_used", "response")


def _rule_scored(spark, sf):
    """Rule insights with an outcome and a latency taken from the order."""
    base = S.score_by_rules(calls(spark, sf).join(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey"))
    ok = F.col("o_orderkey") % 20 != 0
    return base.select(
        "insight", ok.alias("success"), F.when(ok, F.col("o_totalprice") / 1000).otherwise(0.0).alias("latency_seconds")
    )


_BATCH = """lat AS (SELECT o_totalprice / 1000 AS l, row_number() OVER (ORDER BY o_totalprice) AS rn, count(*) OVER () AS n
    FROM orders WHERE o_orderkey % 20 <> 0)"""


@check(
    "batch_result",
    f"""WITH {_BATCH} SELECT count(*) AS total, count(*) FILTER (WHERE o_orderkey % 20 <> 0) AS processed,
        count(*) FILTER (WHERE o_orderkey % 20 = 0) AS failed,
        round(avg(CAST(o_orderkey % 20 <> 0 AS INT)), 6) AS data_quality_rate,
        round((SELECT sum(l) FROM lat), 1) AS total_latency_seconds,
        (SELECT l FROM lat WHERE rn = floor(n * 0.95) + 1) AS p95_latency_seconds FROM orders""",
)
def batch_result(spark, sf):
    out = S.batch_result(_rule_scored(spark, sf)).withColumns(
        {
            "data_quality_rate": F.round("data_quality_rate", 6),
            "total_latency_seconds": F.round(F.col("mean_latency_seconds") * F.col("processed"), 1),
        }
    )
    return out.drop("mean_latency_seconds")


@check(
    "batch_summary",
    f"""WITH {CALLS}, {_BATCH}, c AS (SELECT o_orderkey % 20 <> 0 AS ok, lower(transcript) AS low FROM calls),
        m AS (SELECT *, CASE WHEN {_any('low', V.RULE_POSITIVE)} THEN 'positive' WHEN {_any('low', V.RULE_NEGATIVE)} THEN 'negative'
                ELSE 'neutral' END AS mood FROM c),
        t AS (SELECT CASE WHEN contains(low, 'roas') THEN 'Performance Metrics' ELSE 'Budget Optimization' END AS v FROM m WHERE ok
              UNION ALL SELECT 'Campaign Structure' FROM m WHERE ok),
        tc AS (SELECT v, count(*) AS n FROM t GROUP BY 1)
        SELECT count(*) AS total_calls, count(*) FILTER (WHERE ok) AS processed_calls, count(*) FILTER (WHERE NOT ok) AS failed_calls,
          round(100.0 * count(*) FILTER (WHERE ok AND mood = 'positive') / count(*) FILTER (WHERE ok), 4)::DOUBLE AS positive_sentiment_pct,
          round(100.0 * count(*) FILTER (WHERE ok AND mood = 'negative') / count(*) FILTER (WHERE ok), 4)::DOUBLE AS negative_sentiment_pct,
          round(100.0 * count(*) FILTER (WHERE ok AND {_any('low', V.RULE_URGENT)}) / count(*) FILTER (WHERE ok), 4)::DOUBLE AS high_urgency_pct,
          (SELECT string_agg(v, '|' ORDER BY n DESC, v) FROM tc) AS top_topics, 'below_target_roas' AS top_complaints,
          (SELECT l FROM lat WHERE rn = floor(n * 0.95) + 1) AS p95_latency_seconds FROM m""",
)
def batch_summary(spark, sf):
    s = S.batch_summary(_rule_scored(spark, sf))
    return s.select(
        "total_calls",
        "processed_calls",
        "failed_calls",
        F.round(F.col("positive_sentiment_pct").cast("double"), 4).alias("positive_sentiment_pct"),
        F.round(F.col("negative_sentiment_pct").cast("double"), 4).alias("negative_sentiment_pct"),
        F.round(F.col("high_urgency_pct").cast("double"), 4).alias("high_urgency_pct"),
        F.array_join("top_topics", "|").alias("top_topics"),
        F.array_join("top_complaints", "|").alias("top_complaints"),
        "p95_latency_seconds",
    )
