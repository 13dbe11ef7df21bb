"""Incremental call ingest and the plumbing shared by streaming jobs."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from parley.sources.landing import marketplace_of


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(path)


def run_to_files(stream: DataFrame, folder: str) -> DataFrame:
    """Process all available input, append the result to Parquet, and read it back."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/state")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")


#: Time of the row that closes a stream; no window or timer of the input reaches it, and it still fits nanoseconds.
CLOSING_TIME = "2250-01-01 00:00:00"


def run_to_end(
    rows: DataFrame,
    job: Callable[[DataFrame], DataFrame],
    folder: str,
    ts: str = "ts",
    closing_values: Mapping[str, object] | None = None,
) -> DataFrame:
    """Run ``job`` over all of a finite stream, windows and timers that are open at its end included.

    The watermark stands still at the end of the input, so what is open there would never be given out. When all
    input is processed, a second run of the same query reads one closing row: every column NULL but a time far
    ahead and ``closing_values``, with which the row must pass the job's filters. It moves the watermark past
    everything, and its own window stays open. The query is over with that: later
    rows would all be late. The input must end for good, as that of a backfill or of a sealed day does.
    """
    spark = rows.sparkSession
    kept = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    closing, path = spark.createDataFrame([], kept), f"{folder}/closing"
    closing.write.mode("ignore").parquet(path)
    stream = job(rows.unionByName(file_stream(spark, path, kept)))
    run_to_files(stream, folder)
    last = {**(closing_values or {}), ts: CLOSING_TIME}
    values = [F.lit(last.get(f.name)).cast(f.dataType).alias(f.name) for f in kept]
    spark.range(1).select(*values).write.mode("append").parquet(path)
    return run_to_files(stream, folder)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the watermark has dropped, over the progress that the query still remembers."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def ingest_calls(
    calls: DataFrame, path: str, state: str, ts: str = "ts", lateness: str = "1 day", run_date: str | None = None
) -> StreamingQuery:
    """Land each conversation once, by marketplace, date and micro-batch.

    Every micro-batch owns its ``batch`` partitions, so one that is replayed after a failure
    overwrites what it wrote before and touches nothing else. A stateful query runs without adaptive execution,
    which alone heeds the rebalance hint; else each state partition would write a file for every partition.
    """

    def land(batch: DataFrame, number: int) -> None:
        date = F.lit(run_date) if run_date else F.date_format(ts, "yyyy-MM-dd")
        conf, adaptive = batch.sparkSession.conf, "spark.sql.adaptive.enabled"
        before = conf.get(adaptive)
        conf.set(adaptive, "true")
        try:
            (
                batch.withColumns({"marketplace": marketplace_of(batch), "date": date, "batch": F.lit(number)})
                .hint("rebalance", "marketplace", "date")
                .write.partitionBy("marketplace", "date", "batch")
                .option("partitionOverwriteMode", "dynamic")
                .mode("overwrite")
                .parquet(path)
            )
        finally:
            conf.set(adaptive, before)

    unique = calls.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(["conversation_id"])
    return (
        unique.writeStream.foreachBatch(land)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
