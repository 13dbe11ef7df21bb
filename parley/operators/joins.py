"""Joins: metadata enrichment, bounded lookup, skew-safe equi join, key profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.text import decode_entities

LOOKUP_BUCKETS = 50


def latest_by_key(df: DataFrame, key: str, version: Sequence[str]) -> DataFrame:
    """One row per non-empty key: the one with the greatest version. Combines before the shuffle."""
    rest = [c for c in df.columns if c != key]
    return (
        df.where(F.length(key) > 0)
        .groupBy(key)
        .agg(F.max_by(F.struct(*rest), F.struct(*version)).alias("__row"))
        .select(key, "__row.*")
    )


# Account columns of an enriched call, and what stands in for a missing one.
ACCOUNT_DEFAULTS = {"account_name": "", "opportunity_stage": "", "marketplace_id": "US", "advertiser_tier": "standard"}


def with_accounts(
    rows: DataFrame, metadata: DataFrame, version: Sequence[str], key: str = "conversation_id"
) -> DataFrame:
    """Rows that have metadata, with the account columns of its last version in place of their own.

    No broadcast is forced: the metadata grows with the calls, so Spark decides by size, and AQE splits a hot key
    of the sort-merge join. What ``rows`` holds is what is shuffled: drop the text first. If both sides are stored
    in buckets of the key (``tables.write_buckets``), nothing is shuffled at all.
    """
    wanted = [c for c in ACCOUNT_DEFAULTS if c in metadata.columns]
    right = latest_by_key(metadata.select(key, *wanted, *[v for v in version if v not in wanted]), key, version)
    joined = rows.drop(*ACCOUNT_DEFAULTS).join(right.select(key, *wanted), key, "inner")
    return joined.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(value)) if name in wanted else F.lit(value)
            for name, value in ACCOUNT_DEFAULTS.items()
        }
    )


def enrich_calls(
    calls: DataFrame, metadata: DataFrame, version: Sequence[str], key: str = "conversation_id"
) -> DataFrame:
    """Whole calls that have metadata, with decoded text and the account columns; the text goes through the join."""
    joined = with_accounts(calls, metadata, version, key)
    added = {"transcript": decode_entities(F.coalesce("transcript", F.lit(""))), "ingestion_enriched": F.lit(True)}
    if "participants" in calls.columns:
        added["participant_count"] = F.size(F.coalesce("participants", F.array()))
    return joined.withColumns(added)


def lookup_bucket(key: Column, buckets: int = LOOKUP_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets))


def lookup_dimension(
    df: DataFrame, dim: DataFrame, bucket: Column, version: Sequence[str], buckets: int = LOOKUP_BUCKETS
) -> DataFrame:
    """Left lookup of ``vertical`` and ``tier`` by bucket number.

    The dimension is cut to the numbers below ``buckets`` and reduced to one row for each, so the broadcast
    side has at most as many rows as there are buckets.
    """
    numbers = dim.where((F.col("bucket") >= 0) & (F.col("bucket") < buckets) & (F.col("bucket") % 1 == 0))
    small = numbers.groupBy("bucket").agg(F.max_by(F.struct("vertical", "tier"), F.struct(*version)).alias("__d"))
    return (
        df.withColumn("__bucket", bucket)
        .join(F.broadcast(small), F.col("__bucket") == F.col("bucket"), "left")
        .withColumn("advertiser_vertical", F.coalesce("__d.vertical", F.lit("unknown")))
        .withColumn("advertiser_tier", F.coalesce("__d.tier", F.lit("standard")))
        .drop("__bucket", "bucket", "__d")
    )


def salted_join(
    left: DataFrame, right: DataFrame, key: str, spread: Column, salts: int = 16, hot_share: float = 0.01
) -> DataFrame:
    """Inner equi join that spreads the hot keys of the left side over ``salts`` tasks.

    A key is hot if it has at least ``hot_share`` of the left rows, so there are at most ``1 / hot_share`` of them,
    which are broadcast. Only their rows of the right side are repeated, once per salt. ``spread`` is a column of
    the left side that varies within a key (an id).
    """
    counts = left.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n")).scalar()
    hot = F.broadcast(counts.where(F.col("__n") >= total * hot_share).select("__key"))
    is_hot = F.col("__key").isNotNull()
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    zero = F.lit(0).cast("bigint")
    lhs = left.join(hot, F.col(key) == F.col("__key"), "left")
    lhs = lhs.withColumn("__salt", F.when(is_hot, F.pmod(F.xxhash64(spread), F.lit(salts))).otherwise(zero)).drop("__key")
    rhs = right.join(hot, F.col(key) == F.col("__key"), "left")
    rhs = rhs.withColumn("__salt", F.explode(F.when(is_hot, every).otherwise(F.array(zero)))).drop("__key")
    return lhs.join(rhs, [key, "__salt"]).drop("__salt")


def key_profile(df: DataFrame, key: str, top: int = 10) -> DataFrame:
    """Hottest keys with their row count and share of all rows."""
    counts = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").cast("double")).scalar()
    return (
        counts.withColumn("share", F.round(F.col("n") / total, 6)).orderBy(F.desc("n"), F.asc("key")).limit(top)
    )
