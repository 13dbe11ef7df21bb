"""Ordered computations that survive a hot key.

A window ``PARTITION BY key ORDER BY ts`` puts a whole key into one task. Here a key is cut into
buckets along its order; the work inside a bucket is an ordinary window, and what flows from bucket
to bucket (a running total, a rank, a position) is carried by a small frame with one row per key and
bucket. Results are exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A bucket is one task's sort; a span of buckets is one task's offsets.
BUCKET_SECONDS = 10
SPAN_BUCKETS = 8640


def time_bucket(ts: Column, seconds: int = BUCKET_SECONDS) -> Column:
    return F.floor(F.unix_timestamp(ts) / seconds)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL; the left side's keys stay."""
    named = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    match = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(named, match, how).drop(*[f"__r_{k}" for k in keys])


def running_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, totals: dict[str, Column]
) -> DataFrame:
    """Add running totals over ``keys`` in ``order``, which must be unique within a key.

    ``bucket`` must not decrease along ``order``; rows with a NULL bucket come first. Offsets are summed in two
    levels, buckets within a span and spans within a key, so that no window sees a key's rows or all its buckets.
    """
    work = df.withColumn("__b", bucket).withColumn("__span", F.floor(F.col("__b") / SPAN_BUCKETS))
    inside = Window.partitionBy(*keys, "__span", "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = work.withColumns({name: F.sum(col).over(inside) for name, col in totals.items()})
    sums = work.groupBy(*keys, "__span", "__b").agg(*[F.sum(col).alias(f"__s_{name}") for name, col in totals.items()])
    spans = sums.groupBy(*keys, "__span").agg(*[F.sum(f"__s_{name}").alias(f"__s_{name}") for name in totals])

    def before(name: str, within: Sequence[str], by: str) -> Column:
        w = Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(f"__s_{name}").over(w), F.lit(0))

    outer = spans.select(*keys, "__span", *[before(n, keys, "__span").alias(f"__p_{n}") for n in totals])
    inner = sums.select(*keys, "__span", "__b", *[before(n, [*keys, "__span"], "__b").alias(f"__o_{n}") for n in totals])
    offsets = null_safe_join(inner, outer, [*keys, "__span"])
    return (
        null_safe_join(local, offsets, [*keys, "__span", "__b"])
        .withColumns({name: F.col(name) + F.col(f"__o_{name}") + F.col(f"__p_{name}") for name in totals})
        .drop("__b", "__span", *[f"__o_{n}" for n in totals], *[f"__p_{n}" for n in totals])
    )


def with_rank(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    name: str = "rank",
) -> DataFrame:
    """Exact 1-based position of each row within its key."""
    return running_totals(df, keys, order, bucket, {name: F.lit(1).cast("bigint")})


def last_rows_blocks(df: DataFrame, keys: Sequence[str], rank: str, last: int, block: int | None = None) -> DataFrame:
    """Cut each key into blocks of consecutive ranks, each led by the ``last`` rows before it.

    Adds ``__block`` and ``__own`` (false for the leading context rows). A row frame of at most
    ``last`` preceding rows can then be evaluated per key and block.
    """
    block = block or 4 * last
    pos = F.col(rank) - 1
    own = F.floor(pos / block)
    lead = (pos % block) >= block - last
    return df.withColumn(
        "__copy",
        F.explode(
            F.when(
                lead,
                F.array(
                    F.struct(own.alias("b"), F.lit(True).alias("own")),
                    F.struct((own + 1).alias("b"), F.lit(False).alias("own")),
                ),
            ).otherwise(F.array(F.struct(own.alias("b"), F.lit(True).alias("own"))))
        ),
    ).select("*", F.col("__copy.b").alias("__block"), F.col("__copy.own").alias("__own")).drop("__copy")


def trailing_totals(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    seconds: int,
    totals: dict[str, Column],
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """Totals over the rows of the last ``seconds`` up to and with the current one.

    A row that is exactly ``seconds`` old still counts. Each row enters once and leaves once: it is
    followed by a copy that takes its amounts back after ``seconds``, and the totals are running sums
    over both. The cost does not grow with the number of rows in the window, as a range frame's
    would. Amounts must be whole numbers (or decimals) to be exact.
    """
    end = F.col(ts) + F.expr(f"INTERVAL {seconds} SECONDS")
    steps = F.array(
        F.struct(F.col(ts).alias("__at"), F.lit(0).alias("__leaves"), *[c.alias(f"__v_{n}") for n, c in totals.items()]),
        F.struct(end.alias("__at"), F.lit(1).alias("__leaves"), *[(-c).alias(f"__v_{n}") for n, c in totals.items()]),
    )
    steps = df.select("*", F.inline(steps))
    # The leaving copy needs its keys, its time and its amounts; the rest would only be shuffled.
    light = {c: F.when(F.col("__leaves") == 0, F.col(c)) for c in df.columns if c not in keys and c != tie}
    both = steps.withColumns(light)
    summed = running_totals(
        both,
        keys,
        ["__at", "__leaves", tie],
        time_bucket(F.col("__at"), bucket_seconds),
        {n: F.col(f"__v_{n}") for n in totals},
    )
    return summed.where("__leaves = 0").drop("__at", "__leaves", *[f"__v_{n}" for n in totals])


def _magnitude_bin(value: Column, per_octave: int) -> Column:
    """Bin that never decreases with the value; its width grows with the magnitude. NaN is sorted last."""
    bins = F.floor(F.signum(value) * F.log2(F.abs(value) * 1e6 + 1) * per_octave)
    return F.when(F.isnan(value), F.lit((1 << 63) - 1)).otherwise(bins)


def _position_in(counts: DataFrame, keys: Sequence[str], by: str, position: str) -> DataFrame:
    """From a histogram (``__n`` per ``by``) keep the entry that holds the 0-based position, and the
    position inside that entry as ``__rest``."""
    upto = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    counted = counts.withColumn("__upto", F.sum("__n").over(upto))
    start = F.col("__upto") - F.col("__n")
    return counted.where((F.col(position) >= start) & (F.col(position) < F.col("__upto"))).select(
        *keys, by, (F.col(position) - start).alias("__rest")
    )


def exact_percentiles(df: DataFrame, value: str, groups: Sequence[str], points: Sequence[float]) -> DataFrame:
    """The element at 0-based position ``floor(n * p)`` of each sorted group, one row per point.

    A coarse histogram finds the bin that holds the position, a fine one inside that bin narrows it
    down, and only the distinct values of the remaining sliver are ranked. Both histograms combine
    before their shuffle and have a bounded number of bins, so no group is ever sorted or sent
    anywhere as a whole; the price is three passes over the group and value columns. A frame that is
    costly to compute should be written first. Columns: groups, ``point``, ``value``.
    """
    coarse, fine = _magnitude_bin(F.col("__v"), 64), _magnitude_bin(F.col("__v"), 64 * 4096)
    keys = [*groups, "point"]
    rows = (
        df.where(F.col(value).isNotNull())
        .select(*groups, F.col(value).cast("double").alias("__v"))
        .withColumn("__c", coarse)
    )
    whole = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    hist = (
        rows.groupBy(*groups, "__c")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__all", F.sum("__n").over(whole))
        .withColumn("point", F.explode(F.array(*[F.lit(float(p)) for p in points])))
        .withColumn("__k", F.floor(F.col("__all") * F.col("point")))
    )
    in_bin = null_safe_join(rows, _position_in(hist, keys, "__c", "__k"), [*groups, "__c"]).withColumn("__f", fine)
    fine_hist = in_bin.groupBy(*keys, "__f").agg(F.count(F.lit(1)).alias("__n"), F.min("__rest").alias("__k"))
    sliver = null_safe_join(in_bin.drop("__rest"), _position_in(fine_hist, keys, "__f", "__k"), [*keys, "__f"])
    values = sliver.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__n"), F.min("__rest").alias("__k"))
    return _position_in(values, keys, "__v", "__k").select(*keys, F.col("__v").alias("value"))
