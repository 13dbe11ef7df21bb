"""Feature record of a call: one projection, no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions import text as X
from parley.functions import vocabulary as V


def _or_default(df: DataFrame, name: str, default: Column) -> Column:
    return F.coalesce(F.col(name), default) if name in df.columns else default


def feature_record(
    calls: DataFrame,
    run_millis: int | None = None,
    positive: Sequence[str] = V.POSITIVE_WORDS,
    negative: Sequence[str] = V.NEGATIVE_WORDS,
    pricing: Sequence[str] = V.PRICING_TERMS,
    competitors: Sequence[str] = V.COMPETITOR_TERMS,
    requests: Sequence[str] = V.REQUEST_TERMS,
    topics: Mapping[str, str] = V.TOPIC_TAGS,
    pains: Mapping[str, str] = V.PAIN_TAGS,
    word_boundary: bool = False,
    keep: Sequence[str] = ("advertiser_id",),
) -> DataFrame:
    """Structs ``metadata``, ``nlp_features`` and ``business_features`` plus run time and version.

    Missing and NULL inputs take the same defaults. Rows without a transcript column value still
    give a record; rows that are NULL as a whole do not exist in a DataFrame.
    """
    keep = [c for c in keep if c in calls.columns]
    words = X.tokens(F.col("__low"))
    staged = calls.select(
        *keep,
        _or_default(calls, "conversation_id", F.lit("")).alias("__id"),
        _or_default(calls, "duration_seconds", F.lit(0)).alias("__seconds"),
        (F.size(F.coalesce("participants", F.array())) if "participants" in calls.columns else F.lit(0)).alias(
            "__people"
        ),
        F.lower(_or_default(calls, "transcript", F.lit(""))).alias("__low"),
    )
    staged = staged.withColumn("__words", words)
    staged = staged.withColumns(
        {"__pos": X.hits(F.col("__words"), positive), "__neg": X.hits(F.col("__words"), negative)}
    )
    low, pos, neg = F.col("__low"), F.col("__pos"), F.col("__neg")
    score = X.lexicon_score(pos, neg)
    label = X.score_label(score)
    pressure = X.pressure_bucket(neg)
    none = F.array().cast("array<string>")
    neutral = F.lit("neutral")
    rival, price = X.mentions(low, competitors, word_boundary), X.mentions(low, pricing, word_boundary)
    millis = F.lit(run_millis) if run_millis is not None else F.unix_millis(F.current_timestamp())
    return staged.select(
        *keep,
        F.struct(
            F.col("__id").alias("conversation_id"),
            F.col("__seconds").alias("duration_seconds"),
            F.col("__people").alias("participant_count"),
            F.size("__words").alias("word_count"),
        ).alias("metadata"),
        F.struct(
            F.round(score, 4).alias("sentiment_score"),
            label.alias("sentiment_label"),
            F.struct(
                F.struct(
                    label.alias("overall_sentiment"),
                    pressure.alias("urgency"),
                    X.tags(low, topics, default="general").alias("primary_topics"),
                    none.alias("secondary_topics"),
                    (pos > neg).alias("call_resolution"),
                    (neg > 2).alias("follow_up_required"),
                ).alias("call_analysis"),
                F.struct(
                    X.tags(low, pains).alias("complaint_keywords"),
                    pressure.alias("severity"),
                    rival.alias("competitor_mentioned"),
                    price.alias("pricing_complaint"),
                ).alias("complaint_analysis"),
                F.struct(
                    X.conditional_label(low, "roas", label).alias("roas_sentiment"),
                    X.conditional_label(low, "cpc", label).alias("cpc_sentiment"),
                    neutral.alias("targeting_effectiveness"),
                    neutral.alias("rep_sentiment"),
                    label.alias("advertiser_sentiment"),
                ).alias("performance_metrics_sentiment"),
            ).alias("advanced_analysis"),
        ).alias("nlp_features"),
        F.struct(
            price.alias("pricing_mentioned"),
            rival.alias("competitor_mentioned"),
            X.mentions(low, requests, word_boundary).alias("feature_request_identified"),
        ).alias("business_features"),
        millis.cast("bigint").alias("processing_timestamp"),
        F.lit(V.PROCESSING_VERSION).alias("processing_version"),
    )
