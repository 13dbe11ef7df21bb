"""Daily rollup per advertiser."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.functions import text as X
from parley.functions import vocabulary as V
from parley.functions.rules import advice_flags, suggestions

ANALYSIS = "nlp_features.advanced_analysis"


def _path(df: DataFrame, path: str) -> bool:
    dtype = df.schema
    for part in path.split("."):
        if not hasattr(dtype, "fieldNames") or part not in dtype.fieldNames():
            return False
        dtype = dtype[part].dataType
    return True


def _optional(df: DataFrame, path: str, empty: Column) -> Column:
    return F.coalesce(F.col(path), empty) if _path(df, path) else empty


def entity_key(df: DataFrame) -> Column:
    """``entity_id``, else ``advertiser_id``, else the conversation id, else unknown."""
    options = [F.nullif(F.col(c), F.lit("")) for c in ("entity_id", "advertiser_id") if c in df.columns]
    if _path(df, "metadata.conversation_id"):
        options.append(F.nullif(F.col("metadata.conversation_id"), F.lit("")))
    return F.coalesce(*options, F.lit("unknown"))


def _by_concern(features: DataFrame) -> DataFrame:
    """Calls and measures by (entity, concern); an entity without any concern has one row with NULL.

    A call becomes one row per concern, and its measures ride on the first of them. The aggregate combines before
    its shuffle, so a hot entity is spread over its concerns. Scores are added as decimals, so that the mean, and
    with it the label, does not depend on how the rows are spread.
    """
    none = F.array().cast("array<string>")
    concerns = F.concat(
        _optional(features, f"{ANALYSIS}.call_analysis.primary_topics", none),
        _optional(features, f"{ANALYSIS}.complaint_analysis.complaint_keywords", none),
        _optional(features, f"{ANALYSIS}.key_topics", none),
    )
    score = _optional(features, "nlp_features.sentiment_score", F.lit(0.0)).cast("decimal(18,8)")
    label = _optional(features, "nlp_features.sentiment_label", F.lit("neutral"))
    rows = features.select(
        entity_key(features).alias("entity_id"),
        score.alias("score"),
        label.alias("label"),
        F.posexplode_outer(concerns).alias("pos", "concern"),
    )
    first = F.coalesce(F.col("pos"), F.lit(0)) == 0
    return rows.groupBy("entity_id", "concern").agg(
        F.count(F.lit(1)).alias("mentions"),
        F.count_if(first).alias("calls"),
        F.sum(F.when(first, F.col("score"))).alias("score"),
        *[F.count_if(first & (F.col("label") == name)).alias(name) for name in V.SENTIMENT_LABELS],
    )


def _entity_totals(features: DataFrame, lists: bool = False) -> DataFrame:
    """Sums, advice flags and number of concerns per entity, of whatever vocabulary: no list of it is built unless asked for."""
    flags = [F.bool_or(flag).alias(f"advice{i}") for i, flag in enumerate(advice_flags(F.col("concern")))]
    named = [F.sort_array(F.collect_list("concern")).alias("concerns")] if lists else []
    return (
        _by_concern(features)
        .groupBy("entity_id")
        .agg(
            F.sum("calls").alias("call_count"),
            (F.sum("score") / F.sum("calls")).alias("mean"),
            F.count("concern").alias("concern_count"),
            *named,
            *flags,
            *[F.sum(name).alias(name) for name in V.SENTIMENT_LABELS],
        )
    )


def _measures() -> list[Column]:
    return [
        F.col("call_count"),
        F.round("mean", 4).cast("double").alias("avg_sentiment_score"),
        X.score_label(F.col("mean")).alias("sentiment_label"),
        F.struct(*V.SENTIMENT_LABELS).alias("sentiment_counts"),
        (F.col("negative") / F.col("call_count")).alias("negative_rate"),
    ]


def entity_measures(features: DataFrame) -> DataFrame:
    """Counts, mean score and label per entity."""
    return _entity_totals(features).select("entity_id", *_measures())


def entity_concerns(features: DataFrame) -> DataFrame:
    """``entity_id, concern, mentions``: a row for each concern of an entity, as wordings may be free text."""
    return _by_concern(features).where("concern IS NOT NULL").select("entity_id", "concern", "mentions")


def concern_lists(concerns: DataFrame, top: int) -> DataFrame:
    """``entity_id, concerns``: the ``top`` most mentioned concerns of each entity, for a report, in order of their name."""
    order = Window.partitionBy("entity_id").orderBy(F.desc("mentions"), "concern")
    leading = concerns.withColumn("n", F.row_number().over(order)).where(F.col("n") <= top)
    return leading.groupBy("entity_id").agg(F.sort_array(F.collect_list("concern")).alias("concerns"))


def rollup(features: DataFrame, rollup_date: str, lists: bool = False) -> DataFrame:
    """One row per entity: measures, number of concerns and suggestions. The concerns are ``entity_concerns``.

    ``lists`` adds ``concerns``, every distinct concern of the entity in order. It is meant for a vocabulary of tags;
    for free text take the rows of ``entity_concerns``.
    """
    flags = [F.col(f"advice{i}") for i in range(len(V.SUGGESTIONS))]
    return _entity_totals(features, lists).select(
        "entity_id",
        *_measures(),
        "concern_count",
        *(["concerns"] if lists else []),
        suggestions(F.col("mean"), flags, F.col("call_count")).alias("improvement_suggestions"),
        F.lit(rollup_date).alias("rollup_date"),
    )
