"""Dashboard numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.features import _any
from checks.registry import check
from checks.views import CALLS, INS, calls, ins
from parley.functions import vocabulary as V
from parley.functions.rules import empty_insight_with, rule_insight
from parley.plans import dashboard as D


@check(
    "kpi_row",
    f"""WITH {INS} SELECT count(*) AS total_calls,
        round((count(*) FILTER (WHERE sentiment = 'positive') + 0.5 * count(*) FILTER (WHERE sentiment = 'neutral'))
              / count(*) * 100, 6)::DOUBLE AS satisfaction_pct,
        round(avg(CAST(schema_valid AS INT)), 6) AS data_quality FROM ins""",
)
def kpi_row(spark, sf):
    k = D.kpis(ins(spark, sf))
    return k.select(
        "total_calls",
        F.round(F.col("satisfaction_pct").cast("double"), 6).alias("satisfaction_pct"),
        F.round("data_quality", 6).alias("data_quality"),
    )


@check("kpi_sentiment_distribution", f"WITH {INS} SELECT sentiment, count(*) AS n FROM ins GROUP BY 1")
def kpi_sentiment_distribution(spark, sf):
    return D.value_counts(ins(spark, sf), "sentiment")


@check(
    "kpi_urgency_distribution",
    f"WITH {INS} SELECT urgency, count(*) AS n FROM ins WHERE urgency IS NOT NULL GROUP BY 1",
)
def kpi_urgency_distribution(spark, sf):
    return D.value_counts(ins(spark, sf), "urgency")


@check("kpi_calls_by_campaign", f"WITH {INS} SELECT campaign_type, count(*) AS n FROM ins GROUP BY 1")
def kpi_calls_by_campaign(spark, sf):
    return D.value_counts(ins(spark, sf), "campaign_type")


@check(
    "kpi_daily_trend",
    f"""WITH {INS} SELECT CAST(call_date AS VARCHAR) AS call_date, count(conversation_id) AS total_calls,
        round(avg(CAST(coalesce(sentiment = 'positive', false) AS INT)), 6) AS positive_rate FROM ins GROUP BY 1""",
)
def kpi_daily_trend(spark, sf):
    return D.daily_trend(ins(spark, sf)).select(
        F.col("call_date").cast("string").alias("call_date"),
        "total_calls",
        F.round("positive_rate", 6).alias("positive_rate"),
    )


_LOW = f"low AS (SELECT lower(transcript) AS low FROM calls)"


@check(
    "kpi_category_coverage",
    f"""WITH {CALLS}, {_LOW}, c AS (SELECT count(*) AS n, 0 AS none FROM low)
        SELECT CAST(position AS INT) AS position, category, CAST(calls AS BIGINT) AS calls, calls::DOUBLE / n AS share FROM (
          SELECT 1 AS position, 'identificationMetrics' AS category, n AS calls, n FROM c
          UNION ALL SELECT 2, 'campaignStructure', n, n FROM c
          UNION ALL SELECT 3, 'campaignScale', n, n FROM c
          UNION ALL SELECT 4, 'budgetAndBidding',
             (SELECT count(*) FROM low WHERE contains(low, 'budget') OR {_any('low', ['auto', 'suggest'])}), n FROM c
          UNION ALL SELECT 5, 'callAnalysis', n, n FROM c
          UNION ALL SELECT 6, 'seasonalContext', none, n FROM c
          UNION ALL SELECT 7, 'actionItems', n, n FROM c
          UNION ALL SELECT 8, 'complaintAnalysis', n, n FROM c
          UNION ALL SELECT 9, 'featureAdaptability', n, n FROM c
          UNION ALL SELECT 10, 'performanceMetricsSentiment', n, n FROM c)""",
)
def kpi_category_coverage(spark, sf):
    return D.category_coverage(calls(spark, sf).select(rule_insight(F.col("transcript")).alias("insight")))


_SPARSE = {
    "identificationMetrics": "o_orderkey % 2 = 0",
    "campaignScale": "o_orderkey % 3 = 0",
    "seasonalContext": "o_orderkey % 5 = 0",
    "actionItems": "o_orderkey % 7 < 3",
    "complaintAnalysis": "o_orderkey % 6 = 0",
}


@check(
    "kpi_sparse_coverage",
    f"WITH {INS} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS category, count(*) FILTER (WHERE {cond}) AS calls FROM ins" for c, cond in _SPARSE.items()
    ),
)
def kpi_sparse_coverage(spark, sf):
    base = ins(spark, sf)
    when = {c: F.expr(cond) for c, cond in _SPARSE.items()}
    none = F.array().cast("array<string>")
    spec = {
        "identificationMetrics": {"repName": F.when(when["identificationMetrics"], "x")},
        "campaignScale": {"scaleIssuesReported": when["campaignScale"]},
        "seasonalContext": {"seasonalEvents": F.when(when["seasonalContext"], F.array(F.lit("x"))).otherwise(none)},
        "actionItems": {"nextSteps": F.when(when["actionItems"], F.array(F.lit("x"))).otherwise(none)},
        "complaintAnalysis": {
            "programSpecificComplaints": {
                "SP": F.when(when["complaintAnalysis"], F.array(F.lit("x"))).otherwise(none)
            }
        },
    }
    out = D.category_coverage(base.select(empty_insight_with(spec).alias("insight")))
    return out.where(F.col("category").isin(*_SPARSE)).select("category", "calls")


@check(
    "kpi_outcome_flow",
    f"""WITH {INS} SELECT sentiment, CASE WHEN resolution_type = 'full_resolution' THEN 'resolved'
        WHEN has_action THEN 'actioned' ELSE 'unresolved' END AS outcome, count(*) AS calls FROM ins GROUP BY ALL""",
)
def kpi_outcome_flow(spark, sf):
    return D.outcome_flow(ins(spark, sf), F.col("sentiment"), F.col("resolution_type"), F.col("has_action"))


@check(
    "kpi_outcome_of_rules",
    f"""WITH {CALLS}, {_LOW} SELECT CASE WHEN {_any('low', V.RULE_POSITIVE)} THEN 'positive'
          WHEN {_any('low', V.RULE_NEGATIVE)} THEN 'negative' ELSE 'neutral' END AS sentiment,
          'actioned' AS outcome, count(*) AS calls FROM low GROUP BY ALL""",
)
def kpi_outcome_of_rules(spark, sf):
    i = calls(spark, sf).select(rule_insight(F.col("transcript")).alias("i"))
    return D.outcome_flow(
        i, F.col("i.callAnalysis.overallSentiment"), F.col("i.callAnalysis.resolutionType"), D.any_action(F.col("i"))
    )
