"""Dashboard numbers over one insights frame. Each is a single aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.rules import differs_from_default
from parley.schemas import CATEGORIES


def kpis(df: DataFrame) -> DataFrame:
    """Total calls, satisfaction (neutral counts half) and share of valid records."""
    total = F.count(F.lit(1))
    good = F.count_if(F.col("sentiment") == "positive") + 0.5 * F.count_if(F.col("sentiment") == "neutral")
    return df.agg(
        total.alias("total_calls"),
        F.when(total > 0, good / total * 100).otherwise(0.0).alias("satisfaction_pct"),
        F.avg(F.col("schema_valid").cast("int")).alias("data_quality"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts of the values that are present, largest first."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
    )


def daily_trend(df: DataFrame) -> DataFrame:
    """Calls and share of positive ones per day; a missing label counts as not positive."""
    positive = F.coalesce(F.col("sentiment") == "positive", F.lit(False)).cast("int")
    return (
        df.groupBy("call_date")
        .agg(F.count("conversation_id").alias("total_calls"), F.avg(positive).alias("positive_rate"))
        .orderBy("call_date")
    )


def category_coverage(df: DataFrame, insight: str = "insight") -> DataFrame:
    """How many calls hold something in each of the ten categories."""
    one = df.agg(
        F.count(F.lit(1)).alias("__total"),
        *[F.count_if(differs_from_default(c, F.col(insight)[c])).alias(c) for c in CATEGORIES],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(c).alias("category"),
                F.col(c).alias("calls"),
                (F.col(c) / F.greatest("__total", F.lit(1))).alias("share"),
            )
            for i, c in enumerate(CATEGORIES)
        ]
    )
    return one.select(F.inline(rows))


def outcome(resolution: Column, has_action: Column) -> Column:
    return (
        F.when(resolution == "full_resolution", "resolved")
        .when(F.coalesce(has_action, F.lit(False)), "actioned")
        .otherwise("unresolved")
    )


def any_action(insight: Column) -> Column:
    return differs_from_default("actionItems", insight["actionItems"])


def outcome_flow(df: DataFrame, sentiment: Column, resolution: Column, has_action: Column) -> DataFrame:
    """Sentiment -> resolved, actioned or unresolved."""
    return (
        df.select(sentiment.alias("sentiment"), outcome(resolution, has_action).alias("outcome"))
        .groupBy("sentiment", "outcome")
        .agg(F.count(F.lit(1)).alias("calls"))
    )
