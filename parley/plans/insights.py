"""The insights layer: calls -> scored and checked -> flat columns -> partitioned catalog table, which the reports read."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions import vocabulary as V
from parley.plans.scoring import Scorer, score_to_table
from parley.sources.tables import DATE_PARTS, date_parts, flatten_insights, register_table, write_partitions, write_placed


def publish_insights(
    rows: DataFrame,
    table: str,
    path: str,
    call_date: Column,
    insight: str = "insight",
    keep: Sequence[str] = (),
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Replace the days of ``rows`` in a catalog table over ``path``, and create the table if it is not there.

    Days that are not in ``rows`` stay, so that a day may be published again. Partition columns come last, as the
    table has them, and queries that name them read no other day's files.

    ``derive`` makes the insight and the kept columns out of narrower rows, to which ``year``, ``month`` and ``day`` are
    added. The rows are then brought together and sorted by day as they are, and widen only on their way into the files.
    """
    if derive is None:
        flat = flatten_insights(rows, insight, call_date, keep)
        write_partitions(flat, path, DATE_PARTS)
    else:
        dated = rows.withColumns(dict(zip(DATE_PARTS, date_parts(call_date), strict=True)))
        sorted_days = dated.hint("rebalance", *DATE_PARTS).sortWithinPartitions(*DATE_PARTS)
        flat = flatten_insights(derive(sorted_days), insight, None, keep)
        write_placed(flat, path, DATE_PARTS)
    register_table(rows.sparkSession, table, path, flat.schema)


def run_insights(
    calls: DataFrame,
    table: str,
    out: str,
    run_date: str,
    scorer: Scorer | None = None,
    keep: Sequence[str] = ("conversation_id", "advertiser_id"),
    date: str = "call_date",
) -> DataFrame:
    """Score a day's calls, publish the valid insights and return the scored rows.

    Scores go to ``out/scored`` first, by ``run_date``, so that the scorer runs once per call and a lost executor
    costs its own tasks. The table under ``out/insights`` takes the valid ones by call date; the others stay in the
    scored rows with their error and fallback, which is the quarantine.
    """
    scored = score_to_table(calls, f"{out}/scored", run_date, scorer, [*keep, date])
    good = scored.where("success").withColumn("processing_version", F.lit(V.PROCESSING_VERSION))
    publish_insights(good, table, f"{out}/insights", F.col(date), keep=[*keep, "processing_version"])
    return scored
