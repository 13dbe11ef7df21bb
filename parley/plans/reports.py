"""The five stored reports over an insights table, and freshness. All take real parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions import vocabulary as V

_MONTH = "year = :year AND month = :month"
_URGENT = "callanalysis_urgencylevel IN (" + ", ".join(f"'{u}'" for u in V.URGENT_LEVELS) + ")"
_URGENCY = (
    "CASE callanalysis_urgencylevel "
    + " ".join(f"WHEN '{name}' THEN {score}" for name, score in V.URGENCY_SCORES.items())
    + " ELSE 1 END"
)

# Predicates name the raw partition columns, so whole days are pruned before any file is opened.
# Where a report needs a grand total, a scalar subquery gives it: a window over everything would
# move all groups into one task.
REPORTS = {
    "daily_sentiment_trend": f"""
        SELECT year, month, day, callanalysis_overallsentiment AS sentiment,
               count(*) AS call_count, round(avg({_URGENCY}), 2) AS avg_urgency_score
        FROM IDENTIFIER(:table) WHERE {_MONTH}
        GROUP BY year, month, day, callanalysis_overallsentiment
        ORDER BY year, month, day, sentiment
    """,
    "top_complaint_keywords": f"""
        WITH mention AS (
            SELECT keyword, count(*) AS frequency
            FROM IDENTIFIER(:table) LATERAL VIEW explode(complaintanalysis_complaintkeywords) k AS keyword
            WHERE {_MONTH} GROUP BY keyword)
        SELECT keyword, frequency,
               CAST(round(frequency * 100.0D / (SELECT sum(frequency) FROM mention), 2) AS DOUBLE) AS pct_of_calls
        FROM mention ORDER BY frequency DESC, keyword LIMIT 20
    """,
    "campaign_type_sentiment": f"""
        WITH per AS (
            SELECT campaignstructure_primarycampaigntype AS campaign_type,
                   callanalysis_overallsentiment AS sentiment, count(*) AS calls
            FROM IDENTIFIER(:table) WHERE {_MONTH} GROUP BY ALL)
        SELECT campaign_type, sentiment, calls,
               round(calls * 100.0D / sum(calls) OVER (PARTITION BY campaign_type), 1) AS pct
        FROM per ORDER BY campaign_type, calls DESC, sentiment
    """,
    "roas_sentiment_by_advertiser": f"""
        SELECT advertiser_id, performancemetricssentiment_roassentiment AS roas_sent_rep,
               performancemetricssentiment_roassentimentadvertiser AS roas_sent_advertiser,
               performancemetricssentiment_advertiserperception AS advertiser_perception,
               count(*) AS calls
        FROM IDENTIFIER(:table)
        WHERE {_MONTH} AND performancemetricssentiment_roassentiment IS NOT NULL
        GROUP BY ALL
        ORDER BY calls DESC, advertiser_id, roas_sent_rep, roas_sent_advertiser, advertiser_perception LIMIT 50
    """,
    "urgency_escalation_rate": f"""
        SELECT year, month, day, count_if({_URGENT}) AS high_urgency_calls, count(*) AS total_calls,
               round(100.0D * count_if({_URGENT}) / count(*), 2) AS high_urgency_pct
        FROM IDENTIFIER(:table) WHERE year = :year
        GROUP BY year, month, day ORDER BY year, month, day
    """,
}


def run_report(spark: SparkSession, name: str, table: str, year: int, month: int | None = None) -> DataFrame:
    """Run a stored report by name on a table or view."""
    if name not in REPORTS:
        raise ValueError(f"unknown report {name!r}; choose one of: {', '.join(sorted(REPORTS))}")
    sql, args = REPORTS[name], {"table": table, "year": year}
    if ":month" in sql:
        if month is None:
            raise ValueError(f"report {name!r} needs a month")
        args["month"] = month
    return spark.sql(sql, args=args)


def in_period(insights: DataFrame, year: int, month: int | None = None) -> DataFrame:
    """Rows of a year or a month, by the raw partition columns: other partitions are not even listed for the scan."""
    rows = insights.where(F.col("year") == year)
    return rows if month is None else rows.where(F.col("month") == month)


def latest_partition(insights: DataFrame, year: int, month: int) -> DataFrame:
    """Last day that has data in a month. Partition values alone: of a partitioned table no column is read."""
    return in_period(insights, year, month).agg(F.max(F.make_date("year", "month", "day")).alias("last_day"))


def freshness_hours(df: DataFrame, ts: str, now: Column) -> DataFrame:
    """Hours between the latest row and ``now``."""
    last = F.max(F.col(ts))
    return df.agg(last.alias("last_write"), ((F.unix_timestamp(now) - F.unix_timestamp(last)) / 3600).alias("hours"))
