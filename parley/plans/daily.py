"""The daily job: calls -> features with account columns -> feature table -> rollup table, both by date."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from parley.functions.text import decode_entities
from parley.operators.joins import lookup_bucket, lookup_dimension, with_accounts
from parley.plans.features import feature_record
from parley.plans.rollup import entity_concerns, rollup
from parley.sources.tables import DATE_PARTS, write_partitions, write_rollup

def day_features(
    calls: DataFrame,
    metadata: DataFrame,
    dimension: DataFrame,
    run_millis: int | None = None,
    version: tuple[str, ...] = ("version",),
) -> DataFrame:
    """Features of the calls that have metadata, with the account columns and the looked-up dimension.

    Features come before the join: a transcript is read once, in the task that scans it, and only narrow rows are
    joined. The lookup takes the advertiser's tier from the dimension.
    """
    text = calls.withColumn("transcript", decode_entities(F.coalesce("transcript", F.lit(""))))
    features = feature_record(text, run_millis, keep=("conversation_id", "advertiser_id"))
    joined = with_accounts(features, metadata, version).drop("advertiser_tier")
    return lookup_dimension(joined, dimension, lookup_bucket(F.col("conversation_id")), version)


def run_day(
    calls: DataFrame,
    metadata: DataFrame,
    dimension: DataFrame,
    out: str,
    run_date: str,
    run_millis: int | None = None,
    version: tuple[str, ...] = ("version",),
) -> dict:
    """Process one day of calls; running it again gives the same tables.

    ``dimension`` has ``bucket, vertical, tier`` and the columns of ``version``. Features are written
    once, and the rollup reads them back: the text is processed a single time, and a lost executor
    costs no more than its own tasks. The record count rides on the write.
    """
    start = time.perf_counter()
    features = day_features(calls, metadata, dimension, run_millis, version)
    day = F.lit(run_date).cast("date")
    dated = features.withColumns({"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)})
    seen = Observation()
    write_partitions(dated.observe(seen, F.count(F.lit(1)).alias("records")), f"{out}/features", DATE_PARTS)

    spark = calls.sparkSession
    year, month, dom = (int(part) for part in run_date.split("-"))
    today = spark.read.parquet(f"{out}/features").where(
        (F.col("year") == year) & (F.col("month") == month) & (F.col("day") == dom)
    )
    write_rollup(rollup(today, run_date), f"{out}/rollup")
    write_rollup(entity_concerns(today).withColumn("rollup_date", F.lit(run_date)), f"{out}/concerns")
    return {"record_count": int(seen.get["records"]), "elapsed_seconds": time.perf_counter() - start}
