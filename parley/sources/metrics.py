"""Metric rows and run metrics."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Column -> (metric name, unit, factor). Rates are emitted as percent.
HEALTH_METRICS = {
    "data_freshness_hours": ("DataFreshnessHours", "None", 1.0),
    "query_latency_p95_ms": ("QueryLatencyP95Ms", "None", 1.0),
    "schema_quality_rate": ("SchemaQualityRate", "None", 1.0),
    "negative_sentiment_rate": ("NegativeSentimentRatePct", "None", 100.0),
    "rolling_negative_rate": ("SentimentRollingAvgNegPct", "None", 100.0),
}
CALL_METRICS = {
    "latency_ms": ("InvocationLatencyMs", "Milliseconds", 1.0),
    "invalid": ("SchemaValidationFailures", "Count", 1.0),
    "circuit_open": ("CircuitBreakerOpen", "Count", 1.0),
    "fallback_used": ("FallbackUsed", "Count", 1.0),
    "quality_rate": ("DataQualityScore", "None", 1.0),
}


def metric_rows(
    df: DataFrame, ts: str, metrics: Mapping[str, tuple[str, str, float]], dimensions: Sequence[str] = ()
) -> DataFrame:
    """Wide metrics -> one row per metric: ``ts, name, value, unit, dimensions``."""
    points = [
        F.struct(
            F.lit(name).alias("name"),
            (F.col(col).cast("double") * factor).alias("value"),
            F.lit(unit).alias("unit"),
        )
        for col, (name, unit, factor) in metrics.items()
        if col in df.columns
    ]
    pairs = [x for d in dimensions for x in (F.lit(d), F.col(d).cast("string"))]
    labels = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return df.select(F.col(ts).alias("ts"), labels.alias("dimensions"), F.inline(F.array(*points))).where(
        F.col("value").isNotNull()
    )


def write_metrics(rows: DataFrame, path: str, run: str) -> None:
    """Write the points of a run. A run is a partition, so a replay replaces its own points and no other's.

    ``run`` names what the points are of (a job and its interval), and not the attempt.
    """
    stamped = rows.withColumn("run", F.lit(run).cast("string"))
    stamped.write.partitionBy("run").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def write_with_run_metrics(df: DataFrame, path: str) -> dict:
    """Write once and report rows, partitions up to the last that has rows, seconds and settings.

    The counts ride on the same job.
    """
    spark: SparkSession = df.sparkSession
    seen = Observation()
    start = time.perf_counter()
    counts = [F.count(F.lit(1)).alias("records"), F.max(F.spark_partition_id()).alias("last")]
    df.observe(seen, *counts).write.mode("overwrite").parquet(path)
    return {
        "record_count": int(seen.get["records"]),
        "elapsed_seconds": time.perf_counter() - start,
        "partition_count": 0 if seen.get["last"] is None else int(seen.get["last"]) + 1,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
        "adaptive": spark.conf.get("spark.sql.adaptive.enabled") == "true",
        "skew_join": spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true",
    }
