"""Monitors over the call log: quality, latency, token use, request rate, failure bursts.

The log has one row per request: ``ts``, a unique ``event_id``, group columns such as ``team``,
``latency_ms``, ``schema_valid``, ``failed``, ``output_tokens`` and, where known, ``fallback_used`` and
``circuit_state``. A few teams may hold most of the log, so nothing here orders a whole team in one
task.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.functions import vocabulary as V
from parley.operators.scan import (
    exact_percentiles,
    last_rows_blocks,
    null_safe_join,
    running_totals,
    time_bucket,
    trailing_totals,
)

PERCENTILES = (0.50, 0.90, 0.95, 0.99)


def quality_report(log: DataFrame, groups: Sequence[str] = (), sla: float = V.QUALITY_SLA) -> DataFrame:
    """Passed, failed, fallbacks and open circuits over all requests, fallbacks included."""
    fallback = F.col("fallback_used") if "fallback_used" in log.columns else F.lit(False)
    opened = (F.col("circuit_state") == "OPEN") if "circuit_state" in log.columns else F.lit(False)
    agg = log.groupBy(*groups).agg(
        F.count_if("schema_valid").alias("passed"),
        F.count_if(~F.coalesce("schema_valid", F.lit(False))).alias("failed"),
        F.count_if(fallback).alias("fallbacks"),
        F.count_if(opened).alias("circuit_opens"),
    )
    total = F.col("passed") + F.col("failed")
    rate = F.when(total > 0, F.col("passed") / total).otherwise(0.0)
    return agg.withColumn("quality_rate", rate).withColumn("meets_sla", F.col("quality_rate") >= sla)


def latency_distribution(
    log: DataFrame, latency: str, groups: Sequence[str], points: Sequence[float] = PERCENTILES
) -> DataFrame:
    """Count, mean, extremes and the percentile elements per group."""
    basic = log.groupBy(*groups).agg(
        F.count(latency).alias("calls"),
        F.avg(latency).alias("mean"),
        F.min(latency).alias("min"),
        F.max(latency).alias("max"),
    )
    names = {p: f"p{round(p * 100)}" for p in points}
    wide = (
        exact_percentiles(log, latency, groups, points)
        .groupBy(*groups)
        .agg(*[F.max(F.when(F.col("point") == p, F.col("value"))).alias(n) for p, n in names.items()])
    )
    if not groups:
        return basic.withColumns({n: wide.select(n).scalar() for n in names.values()})
    return null_safe_join(basic, wide, groups, "left")


def rolling_quality(
    log: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = ("ts", "event_id"),
    last: int = V.ROLLING_CALLS,
    sla: float = V.QUALITY_SLA,
) -> DataFrame:
    """Quality over the last ``last`` calls of a key, for every call.

    The window holds a fixed number of rows, so its failures are the difference of two running
    totals that lie ``last`` ranks apart.
    """
    one = F.lit(1).cast("bigint")
    bad = F.when(F.coalesce("schema_valid", F.lit(False)), 0).otherwise(1).cast("bigint")
    ranked = running_totals(log, keys, order, time_bucket(F.col(order[0])), {"__rank": one, "__bad": bad})
    blocks = last_rows_blocks(ranked, keys, "__rank", last)
    w = Window.partitionBy(*keys, "__block").orderBy("__rank")
    failures = F.col("__bad") - F.coalesce(F.lag("__bad", last).over(w), F.lit(0))
    size = F.least("__rank", F.lit(last).cast("bigint"))
    return (
        blocks.withColumns({"failure_count": failures, "window_size": size})
        .where("__own")
        .drop("__rank", "__bad", "__block", "__own")
        .withColumn("quality_rate", 1 - F.col("failure_count") / F.col("window_size"))
        .withColumn("meets_sla", (F.col("window_size") - F.col("failure_count")) / F.col("window_size") >= sla)
    )


def rolling_latency(
    log: DataFrame,
    keys: Sequence[str],
    latency: str = "latency_ms",
    order: Sequence[str] = ("ts", "event_id"),
    last: int = V.ROLLING_CALLS,
    point: float = 0.95,
) -> DataFrame:
    """Mean and percentile element of the last ``last`` calls of a key, for every call.

    A key is cut into blocks of a few thousand calls. Inside a block a sorted list of ``last`` values
    moves along the rows; a window frame would sort ``last`` values anew for every row.
    """
    one = F.lit(1).cast("bigint")
    log = log.where(F.col(latency).isNotNull())
    ranked = running_totals(log, keys, order, time_bucket(F.col(order[0])), {"__rank": one})
    blocks = last_rows_blocks(ranked, keys, "__rank", last)
    out = [*keys, *[o for o in order if o not in keys], latency]
    schema = ", ".join(f"`{n}` {log.schema[n].dataType.simpleString()}" for n in out)

    def slide(block: pd.DataFrame) -> pd.DataFrame:
        from bisect import bisect_left, insort
        from collections import deque
        from math import floor

        block = block.sort_values("__rank")
        recent: deque = deque()
        ordered: list = []
        marks = []
        for value in block[latency]:
            if len(recent) == last:
                del ordered[bisect_left(ordered, recent.popleft())]
            recent.append(value)
            insort(ordered, value)
            marks.append(ordered[floor(len(ordered) * point)])
        means = block[latency].rolling(last, min_periods=1).mean()
        block = block.assign(rolling_mean=means, rolling_mark=marks, window_size=block["__rank"].clip(upper=last))
        return block.loc[block["__own"], [*out, "rolling_mean", "rolling_mark", "window_size"]]

    return (
        blocks.select(*out, "__rank", "__block", "__own")
        .groupBy(*keys, "__block")
        .applyInPandas(slide, f"{schema}, rolling_mean double, rolling_mark double, window_size bigint")
    )


def token_use(
    log: DataFrame,
    keys: Sequence[str],
    tokens: Column,
    seconds: int = V.TOKEN_WINDOW_SECONDS,
    budget: int = V.TOKENS_PER_WINDOW,
    max_tokens: int = V.MAX_OUTPUT_TOKENS,
    burndown: float = 1.0,
) -> DataFrame:
    """Token use of the trailing window before each call, and what the call would bring it to."""
    own = F.coalesce(tokens, F.lit(0)).cast("bigint")
    amounts = {"__used": own, "__calls": F.lit(1).cast("bigint")}
    summed = trailing_totals(log, keys, "ts", "event_id", seconds, amounts)
    before = (F.col("__used") - own) * burndown
    return summed.withColumns(
        {
            "used_before": before,
            "projected_use": before + max_tokens * burndown,
            "over_budget": before + max_tokens * burndown > budget,
            "utilization_pct": F.round(F.col("__used") * burndown * 100 / budget, 1),
            "calls_in_window": F.col("__calls"),
        }
    ).drop("__used", "__calls")


def request_rate(
    log: DataFrame, keys: Sequence[str], window: str = "1 minute", capacity: int = V.REQUESTS_PER_MINUTE
) -> DataFrame:
    """Requests per key and fixed window, with utilization and an over-capacity mark."""
    return (
        log.groupBy(*keys, F.window("ts", window).alias("__w"))
        .agg(F.count(F.lit(1)).alias("requests"))
        .select(
            *keys,
            F.col("__w.start").alias("window_start"),
            "requests",
            F.round(F.col("requests") * 100.0 / capacity, 1).alias("utilization_pct"),
            (F.col("requests") > capacity).alias("over_capacity"),
        )
    )


def failure_bursts(
    log: DataFrame,
    keys: Sequence[str],
    seconds: int = V.FAILURE_WINDOW_SECONDS,
    limit: int = V.FAILURE_LIMIT,
) -> DataFrame:
    """Failures at which the trailing window holds at least ``limit`` failures."""
    failed = log.where("failed")
    one = {"failures": F.lit(1).cast("bigint")}
    counted = trailing_totals(failed, keys, "ts", "event_id", seconds, one)
    return counted.where(F.col("failures") >= limit)


def failure_incidents(log: DataFrame, keys: Sequence[str], gap_seconds: int = V.INCIDENT_GAP_SECONDS) -> DataFrame:
    """Runs of failures whose neighbours are at most ``gap_seconds`` apart.

    Failures in one slot of that length always belong together, so slots are aggregated first and
    only they are put in order: their number depends on the time span and not on the failures.
    """
    micros = F.unix_micros(F.col("ts"))
    gap = gap_seconds * 1_000_000
    slots = (
        log.where("failed")
        .groupBy(*keys, F.floor(micros / gap).alias("__slot"))
        .agg(F.min(micros).alias("__first"), F.max(micros).alias("__last"), F.count(F.lit(1)).alias("__n"))
    )
    w = Window.partitionBy(*keys).orderBy("__slot")
    gone = F.col("__first") - F.lag("__last").over(w) > gap
    marked = slots.withColumn("__new", F.coalesce(gone, F.lit(True)).cast("int"))
    marked = marked.withColumn("__id", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        marked.groupBy(*keys, "__id")
        .agg(F.min("__first").alias("__s"), F.max("__last").alias("__e"), F.sum("__n").alias("failures"))
        .select(
            *keys,
            F.timestamp_micros("__s").alias("started"),
            F.timestamp_micros("__e").alias("ended"),
            "failures",
        )
    )
