"""A mix of sources to target weights, in the order of a time-varying curriculum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import has, running_before, written

WEIGHTS = (3.0, 1.0, 2.0)
#: Knots (time from 0 to 1, factor) of the sources' weight schedules, in turn: steady, rising, falling.
SCHEDULES = (((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.5), (1.0, 1.5)), ((0.0, 1.5), (0.5, 0.5), (1.0, 0.5)))
#: The table of sources has a row for each and is broadcast; more than these are an error, not a cut.
MAX_SOURCES = 100_000


def measured(docs: DataFrame) -> DataFrame:
    """Adds the size in words (0 for a NULL text) and a hash that orders a source's documents."""
    text = has(docs, "text", "string")
    size = F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    return docs.withColumns({"__size": size, "__hash": F.xxhash64(has(docs, "doc_id", "long"), text)})


def source_targets(rows: DataFrame, weights: Sequence[float], share: float, most: float, schedules: Sequence) -> DataFrame:
    """A row for each source: number by code point (NULL last), size, target and the integrated schedule.

    Targets rise together in proportion to the weights and stop at ``most`` times a source's size:
    sources are sorted by the level at which they stop, and the level of the others is what is left
    of the budget over the weights that are left.
    """
    sources = written(rows.groupBy(F.col("source").alias("__source")).agg(F.sum("__size").alias("source_size")), "sources")
    if sources.count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources; map them to fewer before mixing")
    rank = F.row_number().over(Window.orderBy(F.col("__source").asc_nulls_last())) - 1
    everything, row = Window.partitionBy(), Window.orderBy("__stop", "__s")
    earlier = row.rowsBetween(Window.unboundedPreceding, -1)

    def in_turn(values: Sequence) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("__s") % len(values) + 1).cast("int"))

    budget = F.sum("source_size").over(everything) * F.lit(share)
    left = budget - F.coalesce(F.sum("__cap").over(earlier), F.lit(0.0))
    weight_left = F.sum("__weight").over(everything) - F.coalesce(F.sum("__weight").over(earlier), F.lit(0.0))
    return (
        sources.withColumn("__s", rank)
        .withColumn("__weight", in_turn([float(w) for w in weights]))
        .withColumn("__cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("__stop", F.col("__cap") / F.col("__weight"))
        .withColumn("__level", left / weight_left)
        .withColumn("__level", F.min(F.when(F.col("__level") <= F.col("__stop"), F.struct("__stop", "__s", "__level"))).over(everything)["__level"])
        .withColumn("target", F.least("__cap", F.coalesce(F.col("__weight") * F.col("__level"), F.col("__cap"))))
        .withColumn("__knots", in_turn([_integral(s) for s in schedules]))
        .select("__source", "__s", "source_size", "target", "__knots")
    )


def _integral(knots: Sequence[tuple[float, float]]) -> Column:
    """Pieces of a schedule: start, width, factors at both ends, share of the demand before, whole integral."""
    area, pieces = 0.0, []
    for (t, a), (u, b) in zip(knots, knots[1:], strict=False):
        pieces.append((t, u - t, a, b, area))
        area += (u - t) * (a + b) / 2
    names = ("t", "d", "a", "b", "before")
    return F.array(*[F.struct(*[F.lit(float(v)).alias(n) for n, v in zip((*names, "area"), (*p, area), strict=True)]) for p in pieces])


def position(demand: Column, knots: Column) -> Column:
    """The time at which a source's cumulative demand reaches a share of its target.

    Within a piece the weight is linear, so the demand is a quadratic in time; its root is taken in the
    form that has no difference of near numbers and also holds where the weight is constant.
    """
    piece = F.element_at(F.filter(knots, lambda p: p["before"] <= demand * p["area"]), -1)
    rest = demand * piece["area"] - piece["before"]
    slope = (piece["b"] - piece["a"]) / piece["d"]
    root = F.sqrt(F.greatest(piece["a"] * piece["a"] + rest * slope * 2, F.lit(0.0)))
    return piece["t"] + F.when(rest <= 0, F.lit(0.0)).otherwise(rest * 2 / (piece["a"] + root))


def planned(
    rows: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    schedules: Sequence = SCHEDULES,
) -> DataFrame:
    """Adds ``size, source_size, target, taken, passes`` to ``measured`` documents.

    ``passes`` has an entry (number, position, words) for each time that the mix reads the document.
    A source is read in the order of a hash, again from the start if its target is larger than its
    size; the last read ends within a document, so that a source's words add up to its target, rounded.
    A document is taken ``most`` times at most. A text without words is taken 0 words, with a pass of
    its own wherever its source is read. NULL is a source like any other and comes last. Repeated rows
    are interchangeable. An empty table gives no rows. Columns of the input with these names are replaced.
    """
    names = ["size", "source_size", "target", "taken", "passes"]
    rows = rows.drop(*names, "__s", "__source", "__knots")
    if "source" not in rows.columns:
        rows = rows.withColumn("source", F.lit(None).cast("string"))
    sources = source_targets(rows, weights, share, most, schedules)
    rows = rows.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    rows = running_before(rows, "__s", "__hash", ["__size"], F.col("__size"), "__before")
    whole = F.round("target").cast("long")

    def one(k: int) -> Column:
        begin = F.col("__before") + F.lit(k) * F.col("source_size")
        words = F.least(F.col("__size"), whole - begin)
        at = position(begin / F.greatest(whole, F.lit(1)), F.col("__knots"))
        read = (begin < whole) & ((F.col("__size") > 0) | F.lit(k == 0)) | (F.lit(k == 0) & (F.col("source_size") == 0))
        return F.when(read, F.struct(F.lit(k).alias("pass"), at.alias("position"), words.alias("words")))

    times = range(-(-int(most * 1000) // 1000))
    return (
        rows.withColumn("passes", F.filter(F.array(*[one(k) for k in times]), lambda p: p.isNotNull()))
        .withColumn("taken", F.aggregate("passes", F.lit(0).cast("long"), lambda a, p: a + p["words"]))
        .withColumnRenamed("__size", "size")
        .drop("__hash", "__before", "__knots", "__s")
    )


ORDER = ("position", "doc_id", "pass")


def training_order(planned_rows: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """A row for each pass, range-sorted by position: ``words`` of the document's words are read there."""
    rows = planned_rows.withColumn("__pass", F.explode("passes"))
    rows = rows.withColumns({k: F.col(f"__pass.{k}") for k in ("pass", "position", "words")}).drop("__pass", "passes")
    return rows.repartitionByRange(*ORDER, *ties).sortWithinPartitions(*ORDER, *ties)


def training_stream(planned_rows: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """The passes in training order as a written table, with ``start``: the words that the mix reads before.

    A part of the range sort is a file; parts are summed first, so that no window covers more than one of them.
    """
    ranged = training_order(planned_rows, ties).withColumn("__part", F.spark_partition_id())
    passes = written(ranged, "training_order")
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = passes.groupBy("__part").agg(F.sum("words").alias("__sum"))
    offsets = parts.select("__part", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"))
    within = Window.partitionBy("__part").orderBy(*ORDER, *ties).rowsBetween(Window.unboundedPreceding, -1)
    begun = F.col("__offset") + F.coalesce(F.sum("words").over(within), F.lit(0))
    return passes.join(F.broadcast(offsets), "__part").withColumn("start", begun).drop("__part", "__offset")


def mix(rows: DataFrame, **options) -> DataFrame:
    """The mix by document: the columns of ``planned``, with ``taken`` and ``passes`` as the training stream has them.

    Every pass goes through the range sort and gets its place in it, ``start``; ``passes`` lists a document's passes
    with number, position, words and start, and is empty for one that the mix does not reach. ``options`` are those
    of ``planned``.
    """
    plan = written(planned(rows, **options).withColumn("__row", F.monotonically_increasing_id()), "mix")
    stream = training_stream(plan.select("doc_id", "__row", "passes"), ["__row"])
    read = F.struct("pass", "position", "words", "start")
    found = stream.groupBy("__row").agg(F.sum("words").alias("taken"), F.array_sort(F.collect_list(read)).alias("passes"))
    none = F.array().cast(found.schema["passes"].dataType)
    return (
        plan.drop("taken", "passes")
        .join(found, "__row", "left")
        .withColumns({"taken": F.coalesce("taken", F.lit(0).cast("long")), "passes": F.coalesce("passes", none)})
        .drop("__row")
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents as the mix reads them, in training order, with the columns of ``docs``.

    A document comes once for each pass; the pass that its source's target cuts short counts if at
    least half of the document is taken.
    """
    columns = docs.columns
    # every column under a name of its own, so that none clashes with those of the mix
    rows = docs.select(
        has(docs, "doc_id", "long").alias("doc_id"),
        has(docs, "text", "string").alias("text"),
        has(docs, "source", "string").alias("source"),
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__row"),
    )
    rows = training_order(planned(measured(rows).drop("text")))
    return rows.filter(F.col("words") * 2 >= F.col("size")).select("__row.*")
