"""Structured Streaming monitors. Each takes a streaming frame and returns one; the caller picks
source, sink and trigger."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from parley.functions import vocabulary as V

LATENESS = "10 minutes"


def quality_windows(log: DataFrame, window: str = "5 minutes", lateness: str = LATENESS) -> DataFrame:
    """Call quality per tumbling window; rows later than the watermark are dropped."""
    return (
        log.withWatermark("ts", lateness)
        .groupBy(F.window("ts", window).alias("w"))
        .agg(F.count(F.lit(1)).alias("calls"), F.count_if("schema_valid").alias("passed"))
        .select(F.col("w.start").alias("window_start"), "calls", "passed", (F.col("passed") / F.col("calls")).alias("quality_rate"))
    )


def team_load(
    log: DataFrame,
    keys: Sequence[str] = ("team",),
    window: str = "60 seconds",
    slide: str = "10 seconds",
    lateness: str = LATENESS,
) -> DataFrame:
    """Token use and failures per team and sliding window."""
    return (
        log.withWatermark("ts", lateness)
        .groupBy(*keys, F.window("ts", window, slide).alias("w"))
        .agg(F.sum("output_tokens").alias("tokens"), F.count_if("failed").alias("failures"))
        .select(*keys, F.col("w.start").alias("window_start"), "tokens", "failures")
    )


def incident_windows(
    log: DataFrame,
    keys: Sequence[str] = ("team",),
    gap: str = f"{V.INCIDENT_GAP_SECONDS} seconds",
    lateness: str = LATENESS,
) -> DataFrame:
    """Failure incidents: sessions of failures with a gap in between. Only failures move the watermark."""
    return (
        log.where("failed")
        .withWatermark("ts", lateness)
        .groupBy(*keys, F.session_window("ts", gap).alias("w"))
        .agg(F.count(F.lit(1)).alias("failures"))
        .select(*keys, F.col("w.start").alias("started"), F.col("w.end").alias("closes"), "failures")
    )


ALARM_OUTPUT = "key string, day timestamp, rolling_rate double, streak bigint, fired boolean, late boolean"
ALARM_STATE = "recent array<double>, streak bigint, last_fire bigint, days array<bigint>, rates array<double>"
_NO_DAYS: tuple = ([], 0, None, [], [])


class Alarm:
    """What is kept of a key: the last rates, the streak, the last fire, and the days that wait for the watermark."""

    def __init__(self, limit: float, rows: int, breaches: int, hours: float, kept: tuple = _NO_DAYS):
        self.limit, self.rows, self.breaches, self.gap = limit, rows, breaches, int(hours * 3_600_000_000)
        recent, self.streak, self.last, days, rates = kept
        self.recent = list(recent)
        self.waiting = list(zip(days, rates, strict=True))

    def kept(self) -> tuple:
        return self.recent, int(self.streak), self.last, [d for d, _ in self.waiting], [r for _, r in self.waiting]

    def next(self, day: int, rate: float | None) -> tuple[float | None, int, bool]:
        """Rolling rate, streak and fire of the next day. A day without a rate counts as a row and not in the mean."""
        self.recent = [*self.recent, rate][-self.rows :]
        known = [x for x in self.recent if x is not None]
        mean = sum(known) / len(known) if len(self.recent) == self.rows and known else None
        self.streak = self.streak + 1 if mean is not None and mean > self.limit else 0
        fired = self.streak >= self.breaches and (self.last is None or day - self.last >= self.gap)
        if fired:
            self.last = day
        return mean, self.streak, fired

    def release(self, border: int) -> Iterator[tuple]:
        """The waiting days before ``border``, in order."""
        self.waiting.sort(key=lambda x: (x[0], x[1] is not None, x[1] or 0.0))
        while self.waiting and self.waiting[0][0] < border:
            day, rate = self.waiting.pop(0)
            yield (day, *self.next(day, rate))


def sentiment_alarm_stream(
    daily: DataFrame,
    key: str,
    limit: float = V.NEGATIVE_RATE_LIMIT,
    rows: int = V.ROLLING_DAYS,
    breaches: int = V.BREACH_DAYS,
    hours: float = V.COOLDOWN_HOURS,
    lateness: str = "2 days",
    counted: str = "30 days",
) -> DataFrame:
    """Rolling-rate alarm per key over a stream of ``day, rate`` rows, in whatever order they arrive.

    A day waits in the state until no earlier one may come any more: until the greatest day seen, over all keys, is
    ``lateness`` later. Event-time timers then release it, with or without new rows of its key, so the result is
    that of the batch job. A row that comes after its time is given out at once with ``late`` set and changes
    nothing. Spark drops rows that are later still, by ``counted``, and counts them in the query's progress. A row
    without a day is late.
    """
    behind = F.expr(f"INTERVAL {lateness}") + F.expr(f"INTERVAL {counted}")
    hold = daily.sparkSession.range(1).select(F.unix_micros(F.lit("1970-01-01").cast("timestamp") + F.expr(f"INTERVAL {counted}"))).first()[0]
    total = daily.sparkSession.range(1).select(F.unix_micros(F.lit("1970-01-01").cast("timestamp") + behind)).first()[0]

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        alarm = Alarm(limit, rows, breaches, hours, state.get if state.exists else _NO_DAYS)
        mark = state.getCurrentWatermarkMs()
        border = mark * 1000 + hold if mark > 0 else -(1 << 62)
        out = []
        for batch in batches:
            for day, rate in zip(batch["micros"], batch["rate"], strict=True):
                rate = None if pd.isna(rate) else float(rate)
                if pd.isna(day) or day < border:
                    out.append((None if pd.isna(day) else int(day), None, None, False, True))
                else:
                    alarm.waiting.append((int(day), rate))
        out += [(*x, False) for x in alarm.release(border)]
        state.update(alarm.kept())
        if alarm.waiting:
            state.setTimeoutTimestamp(max((alarm.waiting[0][0] - hold) // 1000 + 1, mark + 1))
        frame = pd.DataFrame(out, columns=["day", "rolling_rate", "streak", "fired", "late"])
        frame.insert(0, "key", k[0])
        frame["day"] = pd.to_datetime(frame["day"].astype("Int64"), unit="us")
        frame["streak"] = frame["streak"].astype("Int64")
        yield frame

    rows_in = daily.select(F.col(key).alias("key"), F.col("day").cast("timestamp").alias("day"), F.col("rate").cast("double").alias("rate"))
    rows_in = rows_in.withColumn("micros", F.unix_micros("day")).withWatermark("day", f"{total // 1_000_000} seconds")
    return rows_in.groupBy("key").applyInPandasWithState(step, ALARM_OUTPUT, ALARM_STATE, "append", GroupStateTimeout.EventTimeTimeout)
