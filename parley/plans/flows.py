"""Topic -> sentiment flows over records of either layout."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions import text as X
from parley.functions import vocabulary as V
from parley.functions.layouts import unified
from parley.operators.filters import campaign_contains

CAMEL = "processed_insights.callAnalysis"
SNAKE = "nlp_features.advanced_analysis.call_analysis"


def _type_at(df: DataFrame, path: str) -> T.DataType | None:
    dtype: T.DataType = df.schema
    for part in path.split("."):
        if not isinstance(dtype, T.StructType) or part not in dtype.fieldNames():
            return None
        dtype = dtype[part].dataType
    return dtype


def _field(df: DataFrame, path: str) -> Column:
    return F.col(path) if _type_at(df, path) is not None else F.lit(None).cast("string")


def _analysis(df: DataFrame, path: str) -> tuple[Column, Column, Column]:
    """Whether an analysis holds anything, its label and its topics, however their names are spelled."""
    dtype = _type_at(df, path)
    if not isinstance(dtype, T.StructType):
        return F.lit(False), F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    value, fields = unified(F.col(path), dtype)
    given = reduce(lambda a, b: a | b, [F.col(f"{path}.`{f.name}`").isNotNull() for f in dtype])
    label = value["overall_sentiment"].cast("string") if "overall_sentiment" in fields.names else F.lit(None).cast("string")
    if "primary_topics" not in fields.names:
        return given, label, F.lit(None).cast("array<string>")
    topics = value["primary_topics"]
    if not isinstance(fields["primary_topics"].dataType, T.ArrayType):
        topics = F.when(topics.isNotNull(), F.array(topics.cast("string")))
    return given, label, topics.cast("array<string>")


def raw_mentions(df: DataFrame, campaigns: Sequence[str] = ()) -> DataFrame:
    """One row per topic mention as written: ``topic``, ``label`` of the analysis, ``own`` label.

    The analysis of the insights counts if it holds anything, else that of the features. In either one, label and
    topics may have their camelCase or snake_case names, also both in one record.
    """
    given, label, topics = _analysis(df, CAMEL)
    _, other_label, other_topics = _analysis(df, SNAKE)
    if campaigns:
        campaign = F.coalesce(
            F.nullif(_field(df, "campaign_type"), F.lit("")),
            _field(df, "processed_insights.campaignStructure.primaryCampaignType"),
        )
        df = df.where(campaign_contains(campaign, campaigns))
    return df.select(
        F.when(given, label).otherwise(other_label).alias("label"),
        _field(df, "sentiment").alias("own"),
        F.explode(F.when(given, topics).otherwise(other_topics)).alias("topic"),
    ).where(X.is_real_topic(F.col("topic")))


def topic_flows(df: DataFrame, campaigns: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """Mentions per consolidated topic and three-way sentiment.

    Mentions are counted as written first. The long rule chains then run once per distinct wording
    and not once per mention. A record without a usable label in its analysis falls back to its own
    one; without either it is left out.
    """
    written = raw_mentions(df, campaigns).groupBy("topic", "label", "own").agg(F.count(F.lit(1)).alias("n"))
    label = F.coalesce(X.normalize_sentiment(F.col("label"), strict), X.normalize_sentiment(F.col("own"), strict))
    return (
        written.select(X.consolidate_topic(F.col("topic")).alias("topic"), label.alias("sentiment"), "n")
        .where("sentiment IS NOT NULL")
        .groupBy("topic", "sentiment")
        .agg(F.sum("n").alias("mentions"))
    )


def flow_totals(flows: DataFrame) -> DataFrame:
    """Flows, topic totals and sentiment totals in one pass; ``level`` tells them apart."""
    return (
        flows.groupingSets([["topic", "sentiment"], ["topic"], ["sentiment"]], "topic", "sentiment")
        .agg(F.sum("mentions").alias("mentions"), F.grouping_id().alias("__g"))
        .select(
            F.when(F.col("__g") == 0, "flow").when(F.col("__g") == 1, "topic").otherwise("sentiment").alias("level"),
            "topic",
            "sentiment",
            "mentions",
        )
    )


def topic_table(flows: DataFrame, top: int = 8) -> DataFrame:
    """Largest topics with their share of all mentions."""
    per = flows.groupBy("topic").agg(F.sum("mentions").alias("mentions"))
    total = per.agg(F.sum("mentions")).scalar()
    return (
        per.withColumn("pct", F.round(F.col("mentions") * 100.0 / total, 1))
        .orderBy(F.desc("mentions"), F.asc("topic"))
        .limit(top)
    )


def flows_of_top_topics(flows: DataFrame, top: int = 10) -> DataFrame:
    """Flows of the ``top`` largest topics.

    A topic carries its flows (one per label, so at most three) through the top-k, which spares a
    join of the flows with themselves.
    """
    return (
        flows.groupBy("topic")
        .agg(F.sum("mentions").alias("__m"), F.collect_list(F.struct("sentiment", "mentions")).alias("__f"))
        .orderBy(F.desc("__m"), F.asc("topic"))
        .limit(top)
        .select("topic", F.inline("__f"))
    )


def sentiment_table(flows: DataFrame) -> DataFrame:
    """The three labels in fixed order with count and percent, zero where absent."""
    sums = [F.coalesce(F.sum(F.when(F.col("sentiment") == s, F.col("mentions"))), F.lit(0)) for s in V.SENTIMENT_LABELS]
    one = flows.agg(*[c.alias(s) for c, s in zip(sums, V.SENTIMENT_LABELS)])
    total = F.greatest(reduce(lambda a, b: a + b, [F.col(s) for s in V.SENTIMENT_LABELS]), F.lit(1))
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(s).alias("sentiment"),
                F.col(s).alias("mentions"),
                F.round(F.col(s) * 100.0 / total, 1).alias("pct"),
            )
            for i, s in enumerate(V.SENTIMENT_LABELS)
        ]
    )
    return one.select(F.inline(rows))


def leading_topics(flows: DataFrame) -> DataFrame:
    """Topic with the most positive and with the most negative mentions."""
    return (
        flows.where(F.col("sentiment").isin("positive", "negative"))
        .groupBy("sentiment")
        .agg(
            F.min_by("topic", F.struct(-F.col("mentions"), F.col("topic"))).alias("topic"),
            F.max("mentions").alias("mentions"),
        )
    )
