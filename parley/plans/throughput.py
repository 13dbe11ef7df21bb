"""Throughput of one job under the named session profiles."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from statistics import median

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from parley.settings import PROFILES


def run_once(df: DataFrame) -> tuple[int, float]:
    """Execute a frame completely without keeping its rows; (rows, seconds)."""
    seen = Observation()
    start = time.perf_counter()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    return int(seen.get["n"]), time.perf_counter() - start


def compare_profiles(
    spark: SparkSession,
    build: Callable[[], DataFrame],
    profiles: Sequence[str] = ("baseline", "tuned"),
    runs: int = 3,
    overrides: dict[str, str] | None = None,
) -> DataFrame:
    """One row per profile: rows, median seconds, rows per second, gain over the first profile.

    Only settings that a running session may change are applied; they are put back afterwards.
    """
    out: list[tuple] = []
    for name in profiles:
        wanted = {k: v for k, v in {**PROFILES[name], **(overrides or {})}.items() if spark.conf.isModifiable(k)}
        before = {k: spark.conf.get(k, None) for k in wanted}
        try:
            for key, value in wanted.items():
                spark.conf.set(key, value)
            results = [run_once(build()) for _ in range(runs + 1)][1:]
        finally:
            for key, value in before.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)
        rows, seconds = results[0][0], median(s for _, s in results)
        first = out[0][3] if out else rows / seconds
        out.append((name, rows, seconds, rows / seconds, (rows / seconds) / first - 1))
    return spark.createDataFrame(
        out, "profile string, records bigint, seconds double, records_per_second double, gain double"
    )
