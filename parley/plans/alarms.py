"""Alarms over daily rates and health metrics.

Inputs have one row per key and interval (a day, a poll), made by an aggregate. Windows per key
therefore see the length of the history and not the number of calls.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from parley.functions import vocabulary as V
from parley.operators.scan import null_safe_join

# Signal -> (metric column, breach test, reason pattern, limit).
SIGNALS = {
    "DataFreshness": ("data_freshness_hours", "above", "Last ETL write %.1fh ago (threshold %.0fh)", V.STALE_HOURS),
    "QueryLatency": ("query_latency_p95_ms", "above", "p95 query latency %.0fms exceeds %.0fms SLA", V.LATENCY_SLA_MS),
    "SchemaQuality": ("schema_quality_rate", "below", "Schema quality %.4f%% below %.4f%% SLA", V.QUALITY_SLA),
}


def rolling_mean(df: DataFrame, keys: Sequence[str], order: str, rate: str, rows: int = V.ROLLING_DAYS) -> DataFrame:
    """Mean over the last ``rows`` rows, NULL until that many exist. Missing days are skipped."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(1 - rows, 0)
    return df.withColumn("rolling_rate", F.when(F.count(F.lit(1)).over(w) == rows, F.avg(rate).over(w)))


def breach_streak(df: DataFrame, keys: Sequence[str], order: str, breach: Column) -> DataFrame:
    """Number of consecutive rows up to this one for which ``breach`` holds."""
    w = Window.partitionBy(*keys).orderBy(order)
    marked = df.withColumn("__hit", F.coalesce(breach, F.lit(False)))
    marked = marked.withColumn(
        "__island", F.sum(F.when(F.col("__hit"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    inside = Window.partitionBy(*keys, "__island").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    streak = F.when(F.col("__hit"), F.sum(F.col("__hit").cast("int")).over(inside)).otherwise(0)
    return marked.withColumn("streak", streak.cast("bigint")).drop("__hit", "__island")


def fired_with_cooldown(
    df: DataFrame, keys: Sequence[str], ts: str, wants: Column, hours: float = V.COOLDOWN_HOURS
) -> DataFrame:
    """Mark the rows that fire: ``wants`` holds and the last fire is at least ``hours`` ago.

    A wanting row after a pause of at least ``hours`` always fires, so the wanting times of a key are cut at such
    pauses and each piece is folded on its own, with one timestamp as state. Of rows with equal keys and times at
    most one fires. NULL is a key like any other; a row without a time never fires.
    """
    gap = int(hours * 3600 * 1_000_000)
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    marked = df.withColumn("__t", micros).withColumn("__w", F.coalesce(wants, F.lit(False)))
    same = Window.partitionBy(*keys, "__t", "__w").orderBy(*(plain or ["__t"]))
    marked = marked.withColumn("__n", F.row_number().over(same))
    w = Window.partitionBy(*keys).orderBy("__t")
    new = F.coalesce(F.col("__t") - F.lag("__t").over(w) >= gap, F.lit(True))
    times = marked.where("__w AND __t IS NOT NULL").select(*keys, "__t").distinct().withColumn("__new", new.cast("int"))
    times = times.withColumn("__piece", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    empty = F.array().cast("array<bigint>")
    fires = (
        times.groupBy(*keys, "__piece")
        .agg(F.sort_array(F.collect_list("__t")).alias("__ts"))
        .select(
            *keys,
            F.aggregate(
                "__ts",
                F.struct(F.lit(None).cast("bigint").alias("last"), empty.alias("fired")),
                lambda acc, t: F.when(
                    acc["last"].isNull() | (t - acc["last"] >= gap),
                    F.struct(t.alias("last"), F.concat(acc["fired"], F.array(t)).alias("fired")),
                ).otherwise(acc),
                lambda acc: acc["fired"],
            ).alias("__fired"),
        )
        .select(*keys, F.explode("__fired").alias("__t"))
        .withColumn("__hit", F.lit(True))
    )
    return (
        null_safe_join(marked, fires, [*keys, "__t"], "left")
        .withColumn("fired", F.coalesce(F.col("__hit") & F.col("__w") & (F.col("__n") == 1), F.lit(False)))
        .drop("__t", "__w", "__n", "__hit")
    )


def sentiment_alarm(
    daily: DataFrame,
    keys: Sequence[str],
    day: str,
    rate: str,
    limit: float = V.NEGATIVE_RATE_LIMIT,
    rows: int = V.ROLLING_DAYS,
    breaches: int = V.BREACH_DAYS,
    hours: float = V.COOLDOWN_HOURS,
) -> DataFrame:
    """Rolling rate, streak, fire and alarm state per row.

    The state is ALARM on the rows that fire and is cleared by the next row that does not, also when
    only the cooldown kept that row from firing.
    """
    step = rolling_mean(daily, keys, day, rate, rows)
    step = breach_streak(step, keys, day, F.col("rolling_rate") > limit)
    step = fired_with_cooldown(step, keys, day, F.col("streak") >= breaches, hours)
    w = Window.partitionBy(*keys).orderBy(day)
    before = F.coalesce(F.lag("fired").over(w), F.lit(False))
    return step.withColumn("__before", before).select(
        *[c for c in step.columns],
        F.when(F.col("fired"), "ALARM").otherwise("OK").alias("state"),
        F.when(F.col("fired") & ~F.col("__before"), "triggered")
        .when(~F.col("fired") & F.col("__before"), "cleared")
        .alias("transition"),
    )


def health_alarms(health: DataFrame, keys: Sequence[str], ts: str, signals: dict = SIGNALS) -> DataFrame:
    """State of every threshold signal per row, with true transitions, reason and minutes to clear."""
    points = []
    for name, (col, side, pattern, limit) in signals.items():
        value = F.col(col).cast("double")
        scale = 100.0 if "%%" in pattern else 1.0
        points.append(
            F.struct(
                F.lit(name).alias("signal"),
                value.alias("value"),
                F.coalesce(value > limit if side == "above" else value < limit, F.lit(False)).alias("breached"),
                F.format_string(pattern, value * scale, F.lit(float(limit) * scale)).alias("reason"),
            )
        )
    long = health.select(*keys, F.col(ts).alias("ts"), F.inline(F.array(*points)))
    w = Window.partitionBy(*keys, "signal").orderBy("ts")
    was = F.coalesce(F.lag("breached").over(w), F.lit(False))
    long = long.withColumn("__was", was)
    started = F.when(F.col("breached") & ~F.col("__was"), F.col("ts"))
    long = long.withColumn(
        "__since", F.last(started, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    change = (
        F.when(F.col("breached") & ~F.col("__was"), "triggered").when(~F.col("breached") & F.col("__was"), "cleared")
    )
    minutes = (F.unix_timestamp("ts") - F.unix_timestamp("__since")) / 60
    return long.select(
        *keys,
        "signal",
        "ts",
        "value",
        F.when(F.col("breached"), "ALARM").otherwise("OK").alias("state"),
        change.alias("transition"),
        F.when(F.col("breached"), F.col("reason")).otherwise("").alias("reason"),
        F.when(change == "cleared", minutes).alias("minutes_to_clear"),
    )
