"""Landing area: raw calls by marketplace and run date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _filled(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def marketplace_of(df: DataFrame, default: str = "US", role_fallback: bool = False) -> Column:
    """Marketplace of a call; with ``role_fallback`` the first participant's role stands in for it."""
    options = []
    if "marketplace_id" in df.columns:
        options.append(_filled(F.col("marketplace_id")))
    if role_fallback and "participants" in df.columns:
        options.append(F.try_element_at("participants", F.lit(1))["role"])
    return F.coalesce(*options, F.lit(default))


def landing_manifest(df: DataFrame, bucket: str, run_date: str, role_fallback: bool = False) -> DataFrame:
    """Where each call would land and how many UTF-8 bytes it has. Writes nothing."""
    return df.select(
        F.lit(bucket).alias("bucket"),
        F.format_string(
            "raw/%s/date=%s/%s.json",
            marketplace_of(df, role_fallback=role_fallback),
            F.lit(run_date),
            F.coalesce(F.col("conversation_id"), F.lit("unknown")),
        ).alias("key"),
        F.octet_length(F.to_json(F.struct(*df.columns))).alias("size_bytes"),
    )


def write_landing(df: DataFrame, path: str, run_date: str, role_fallback: bool = False) -> None:
    """Write JSON lines to ``marketplace=…/date=…``; a re-run of a date replaces that date only.

    The rebalance keeps one marketplace from becoming one task or one file.
    """
    (
        df.withColumn("marketplace", marketplace_of(df, role_fallback=role_fallback))
        .withColumn("date", F.lit(run_date))
        .hint("rebalance", "marketplace")
        .write.partitionBy("marketplace", "date")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .json(path)
    )
