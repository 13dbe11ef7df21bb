"""Streaming jobs over the events file, run to the end of the input and compared with batch SQL.

Windows and days that are open at the end of the input are closed there, so the twins have all of them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.calllogs import _cooldown_sql
from checks.registry import check
from checks.views import LG, daily_rates, table
from parley.settings import work_folder
from parley.streaming import ingest, monitors


def _event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    raw = ingest.file_stream(spark, f"{sf}/events*.parquet", schema)
    error = F.col("event_type") == "error"
    return raw.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("Team_"), F.char(65 + F.col("user_id") % 18)).alias("team"),
        error.alias("failed"),
        (~error).alias("schema_valid"),
        F.get_json_object("props", "$.k").cast("int").alias("output_tokens"),
    )


_STAMP = "'%Y-%m-%d %H:%M:%S'"


def _stamp(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


@check(
    "stream_quality_windows",
    f"""WITH {LG}, b AS (SELECT time_bucket(INTERVAL '5 minutes', ts, TIMESTAMP '2024-01-01') AS s, count(*) AS calls,
            count(*) FILTER (WHERE schema_valid) AS passed FROM lg GROUP BY 1)
        SELECT strftime(s, {_STAMP}) AS window_start, calls, passed, round(passed::DOUBLE / calls, 6) AS quality_rate FROM b""",
)
def stream_quality_windows(spark, sf):
    out = ingest.run_to_end(_event_stream(spark, sf), monitors.quality_windows, work_folder(spark, "quality"))
    return out.select(
        _stamp("window_start").alias("window_start"), "calls", "passed", F.round("quality_rate", 6).alias("quality_rate")
    )


@check(
    "stream_team_load",
    f"""WITH {LG}, s AS (SELECT *, unnest(range(6)) AS i FROM lg),
        b AS (SELECT team, time_bucket(INTERVAL '10 seconds', ts, TIMESTAMP '2024-01-01') - i * INTERVAL '10 seconds' AS s,
                sum(output_tokens) AS tokens, count(*) FILTER (WHERE failed) AS failures FROM s GROUP BY ALL)
        SELECT team, strftime(s, {_STAMP}) AS window_start, CAST(coalesce(tokens, 0) AS BIGINT) AS tokens, failures FROM b""",
)
def stream_team_load(spark, sf):
    out = ingest.run_to_end(_event_stream(spark, sf), monitors.team_load, work_folder(spark, "load"))
    return out.select(
        "team", _stamp("window_start").alias("window_start"), F.coalesce("tokens", F.lit(0)).alias("tokens"), "failures"
    )


@check(
    "stream_incidents",
    f"""WITH {LG}, f AS (SELECT team, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL '1 hour' THEN 0 ELSE 1 END AS fresh
            FROM lg WHERE failed WINDOW w AS (PARTITION BY team ORDER BY ts)),
        g AS (SELECT *, sum(fresh) OVER (PARTITION BY team ORDER BY ts ROWS UNBOUNDED PRECEDING) AS id FROM f),
        b AS (SELECT team, min(ts) AS s, max(ts) + INTERVAL '1 hour' AS e, count(*) AS failures FROM g GROUP BY team, id)
        SELECT team, strftime(s, '%Y-%m-%d %H:%M:%S.%f') AS started, strftime(e, '%Y-%m-%d %H:%M:%S.%f') AS closes, failures FROM b""",
)
def stream_incidents(spark, sf):
    incidents = lambda log: monitors.incident_windows(log, gap="1 hour")
    out = ingest.run_to_end(_event_stream(spark, sf), incidents, work_folder(spark, "incidents"), closing_values={"failed": True})
    return out.select(
        "team",
        F.date_format("started", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("started"),
        F.date_format("closes", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("closes"),
        "failures",
    )


@check(
    "stream_sentiment_alarm",
    _cooldown_sql(
        72, "SELECT team AS key, strftime(day, '%Y-%m-%d') AS day, CAST(streak AS BIGINT) AS streak, fired FROM done"
    ),
)
def stream_sentiment_alarm(spark, sf):
    """Daily rates as eight files of mixed days, a micro-batch each; days wait in the state for their turn."""
    folder = work_folder(spark, "alarm")
    daily_rates(spark, sf).repartition(8, "team", "day").write.parquet(f"{folder}/daily")
    rates = ingest.file_stream(spark, f"{folder}/daily", spark.read.parquet(f"{folder}/daily").schema, per_trigger=1)
    alarm = lambda rows: monitors.sentiment_alarm_stream(rows, "team", hours=72, lateness="60 days")
    out = ingest.run_to_end(rates, alarm, folder, "day").where("NOT late")
    return out.select("key", F.date_format("day", "yyyy-MM-dd").alias("day"), "streak", "fired")


@check(
    "stream_call_ingest",
    """SELECT CASE event_id % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'UK' ELSE 'DE' END AS marketplace,
        strftime(ts, '%Y-%m-%d') AS date, count(*) AS calls FROM events GROUP BY ALL""",
)
def stream_call_ingest(spark, sf):
    """Every event arrives twice; each conversation is landed once."""
    folder = work_folder(spark, "ingest")
    events = table(spark, sf, "events").select(
        F.concat(F.lit("conv_"), F.col("event_id").cast("string")).alias("conversation_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.element_at(F.array(F.lit("US"), F.lit("UK"), F.lit("DE")), (F.col("event_id") % 3 + 1).cast("int")).alias(
            "marketplace_id"
        ),
    )
    events.unionAll(events).write.parquet(f"{folder}/in")
    stream = ingest.file_stream(spark, f"{folder}/in", events.schema)
    ingest.ingest_calls(stream, f"{folder}/out", f"{folder}/state").awaitTermination()
    return (
        spark.read.parquet(f"{folder}/out")
        .groupBy("marketplace", F.col("date").cast("string").alias("date"))
        .agg(F.count(F.lit(1)).alias("calls"))
    )
