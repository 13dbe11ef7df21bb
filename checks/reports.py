"""Stored reports, freshness and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from checks.views import INS, KW, LG, ins, insight_catalog, lg
from parley.operators import filters
from parley.plans import reports

YEAR, MONTH = 1997, 6


def _report(spark, sf, name, month=MONTH):
    return reports.run_report(spark, name, insight_catalog(spark, sf), YEAR, month)


@check(
    "report_daily_sentiment_trend",
    f"""WITH {INS} SELECT year, month, day, sentiment, count(*) AS call_count,
        CAST(round(avg(CASE urgency WHEN 'high' THEN 3 WHEN 'seasonal_pressure' THEN 4 WHEN 'medium' THEN 2 ELSE 1 END), 2)
             AS DOUBLE) AS avg_urgency_score
        FROM ins WHERE year = {YEAR} AND month = {MONTH} GROUP BY ALL""",
)
def daily_sentiment_trend(spark, sf):
    return _report(spark, sf, "daily_sentiment_trend")


@check(
    "report_top_complaint_keywords",
    f"""WITH {INS}, {KW}, m AS (SELECT keyword FROM ins JOIN kw ON o_orderkey = l_orderkey
            WHERE year = {YEAR} AND month = {MONTH})
        SELECT keyword, count(*) AS frequency,
               CAST(round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS DOUBLE) AS pct_of_calls
        FROM m GROUP BY keyword ORDER BY frequency DESC, keyword LIMIT 20""",
)
def top_complaint_keywords(spark, sf):
    return _report(spark, sf, "top_complaint_keywords")


@check(
    "report_campaign_type_sentiment",
    f"""WITH {INS} SELECT campaign_type, sentiment, count(*) AS calls,
        CAST(round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY campaign_type), 1) AS DOUBLE) AS pct
        FROM ins WHERE year = {YEAR} AND month = {MONTH} GROUP BY campaign_type, sentiment""",
)
def campaign_type_sentiment(spark, sf):
    return _report(spark, sf, "campaign_type_sentiment")


@check(
    "report_roas_by_advertiser",
    f"""WITH {INS} SELECT advertiser_id, roas_sentiment AS roas_sent_rep, sentiment AS roas_sent_advertiser,
        urgency AS advertiser_perception, count(*) AS calls
        FROM ins WHERE year = {YEAR} AND month = {MONTH} AND roas_sentiment IS NOT NULL GROUP BY ALL
        ORDER BY calls DESC, advertiser_id, roas_sent_rep, roas_sent_advertiser, advertiser_perception NULLS FIRST LIMIT 50""",
)
def roas_by_advertiser(spark, sf):
    return _report(spark, sf, "roas_sentiment_by_advertiser")


@check(
    "report_urgency_escalation",
    f"""WITH {INS} SELECT year, month, day,
        CAST(count(*) FILTER (WHERE urgency IN ('high', 'seasonal_pressure')) AS BIGINT) AS high_urgency_calls,
        count(*) AS total_calls,
        CAST(round(100.0 * count(*) FILTER (WHERE urgency IN ('high', 'seasonal_pressure')) / count(*), 2) AS DOUBLE)
          AS high_urgency_pct FROM ins WHERE year = {YEAR} GROUP BY ALL""",
)
def urgency_escalation(spark, sf):
    return _report(spark, sf, "urgency_escalation_rate", None)


@check(
    "report_freshness",
    f"""WITH {INS} SELECT CAST(max(call_date) AS VARCHAR) AS last_day FROM ins WHERE year = {YEAR} AND month = {MONTH}""",
)
def freshness(spark, sf):
    df = reports.latest_partition(spark.table(insight_catalog(spark, sf)), YEAR, MONTH)
    return df.select(F.col("last_day").cast("string").alias("last_day"))


@check(
    "filter_period",
    f"""WITH {INS} SELECT month, count(*) AS calls, count(*) FILTER (WHERE month = {MONTH}) AS calls_of_month
        FROM ins WHERE year = {YEAR} GROUP BY month""",
)
def filter_period(spark, sf):
    """Calls of a year by month, and those of a month by the narrower predicate."""
    insights = spark.table(insight_catalog(spark, sf))
    month = reports.in_period(insights, YEAR, MONTH).groupBy("month").agg(F.count(F.lit(1)).alias("calls_of_month"))
    year = reports.in_period(insights, YEAR).groupBy("month").agg(F.count(F.lit(1)).alias("calls"))
    return year.join(month, "month", "left").select("month", "calls", F.coalesce("calls_of_month", F.lit(0)).alias("calls_of_month"))


@check(
    "report_freshness_hours",
    f"""WITH {LG} SELECT CAST(max(ts) AS DATE)::VARCHAR AS last_day,
        round((epoch(TIMESTAMP '2024-02-01 12:00:00') - floor(epoch(max(ts)))) / 3600, 4) AS hours FROM lg""",
)
def freshness_hours(spark, sf):
    df = reports.freshness_hours(lg(spark, sf), "ts", F.lit("2024-02-01 12:00:00").cast("timestamp"))
    return df.select(F.date_format("last_write", "yyyy-MM-dd").alias("last_day"), F.round("hours", 4).alias("hours"))


@check(
    "filter_dashboard",
    f"""WITH {INS} SELECT conversation_id FROM ins WHERE call_date BETWEEN DATE '1997-03-01' AND DATE '1997-09-30'
        AND campaign_type IN ('Sponsored_Products', 'Sponsored_Brands') AND team IN ('Team_A', 'Team_C', 'Team_R')""",
)
def filter_dashboard(spark, sf):
    return filters.dashboard_filter(
        ins(spark, sf),
        ("1997-03-01", "1997-09-30"),
        ("Sponsored_Products", "Sponsored_Brands"),
        ("Team_A", "Team_C", "Team_R"),
    ).select("conversation_id")


@check(
    "filter_single_day",
    f"WITH {INS} SELECT conversation_id, team FROM ins WHERE call_date = DATE '1997-06-10'",
)
def filter_single_day(spark, sf):
    return filters.dashboard_filter(ins(spark, sf), ("1997-06-10",)).select("conversation_id", "team")


@check(
    "filter_campaign_substring",
    f"""WITH {INS} SELECT campaign_type, count(*) AS n FROM ins
        WHERE contains(replace(lower(campaign_type), '_', ' '), 'sponsored display')
           OR contains(replace(lower(campaign_type), '_', ' '), 'brand') GROUP BY ALL""",
)
def filter_campaign_substring(spark, sf):
    hit = filters.campaign_contains(F.col("campaign_type"), ["Sponsored Display", "BRAND"])
    return ins(spark, sf).where(hit).groupBy("campaign_type").agg(F.count(F.lit(1)).alias("n"))
