"""Call-log monitors and alarms."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from checks.views import DAILY, LG, daily_rates, lg
from parley.plans import alarms as A
from parley.plans import calllog as C
from parley.sources.metrics import CALL_METRICS, HEALTH_METRICS, metric_rows

SIX_HOURS = 6 * 3600


@check(
    "log_quality_report",
    f"""WITH {LG} SELECT team, count(*) FILTER (WHERE schema_valid) AS passed,
        count(*) FILTER (WHERE NOT schema_valid) AS failed, count(*) FILTER (WHERE fallback_used) AS fallbacks,
        count(*) FILTER (WHERE circuit_state = 'OPEN') AS circuit_opens,
        round(avg(CAST(schema_valid AS INT)), 6) AS quality_rate, avg(CAST(schema_valid AS INT)) >= 0.8 AS meets_sla
        FROM lg GROUP BY team""",
)
def log_quality_report(spark, sf):
    return C.quality_report(lg(spark, sf), ["team"], sla=0.8).withColumn("quality_rate", F.round("quality_rate", 6))


@check(
    "log_quality_total",
    f"""WITH {LG} SELECT count(*) FILTER (WHERE schema_valid) AS passed, count(*) FILTER (WHERE NOT schema_valid) AS failed,
        count(*) FILTER (WHERE fallback_used) AS fallbacks, count(*) FILTER (WHERE circuit_state = 'OPEN') AS circuit_opens,
        round(avg(CAST(schema_valid AS INT)), 6) AS quality_rate, avg(CAST(schema_valid AS INT)) >= 0.999 AS meets_sla FROM lg""",
)
def log_quality_total(spark, sf):
    return C.quality_report(lg(spark, sf)).withColumn("quality_rate", F.round("quality_rate", 6))


def _percentile_sql(group: str) -> str:
    part = f"PARTITION BY {group} " if group else ""
    keys = f"{group}, " if group else ""
    by = f"GROUP BY {group}" if group else ""
    marks = ", ".join(
        f"max(CASE WHEN rn = floor(n * {p}) + 1 THEN latency_ms END) AS p{round(p * 100)}" for p in C.PERCENTILES
    )
    return f"""WITH {LG}, r AS (SELECT *, row_number() OVER ({part}ORDER BY latency_ms) AS rn, count(*) OVER ({part}) AS n
          FROM lg WHERE latency_ms IS NOT NULL)
        SELECT {keys}count(*) AS calls, round(avg(latency_ms) * count(*), 2) AS total, min(latency_ms) AS min, max(latency_ms) AS max,
               {marks} FROM r {by}"""


@check("log_latency_by_team", _percentile_sql("team"))
def log_latency_by_team(spark, sf):
    out = C.latency_distribution(lg(spark, sf), "latency_ms", ["team"])
    return out.withColumn("total", F.round(F.col("mean") * F.col("calls"), 2)).drop("mean")


@check("log_latency_total", _percentile_sql(""))
def log_latency_total(spark, sf):
    out = C.latency_distribution(lg(spark, sf), "latency_ms", [])
    return out.withColumn("total", F.round(F.col("mean") * F.col("calls"), 2)).drop("mean")


@check(
    "log_request_rate",
    f"""WITH {LG} SELECT team, strftime(time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '2024-01-01'), '%Y-%m-%d %H:%M:%S') AS window_start,
        count(*) AS requests, CAST(round(count(*) * 100.0 / 6, 1) AS DOUBLE) AS utilization_pct, count(*) > 6 AS over_capacity
        FROM lg GROUP BY 1, 2""",
)
def log_request_rate(spark, sf):
    return C.request_rate(lg(spark, sf), ["team"], "6 hours", 6).withColumn(
        "window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")
    )


@check(
    "log_requests_over_minute_capacity",
    f"""WITH {LG}, w AS (SELECT team, date_trunc('minute', ts) AS m, count(*) AS n FROM lg GROUP BY 1, 2)
        SELECT team, count(*) FILTER (WHERE n > 1) AS minutes_over, max(n) AS busiest FROM w GROUP BY 1""",
)
def log_requests_over_minute_capacity(spark, sf):
    return (
        C.request_rate(lg(spark, sf), ["team"], "1 minute", 1)
        .groupBy("team")
        .agg(F.count_if("over_capacity").alias("minutes_over"), F.max("requests").alias("busiest"))
    )


@check(
    "log_rolling_quality",
    f"""WITH {LG}, r AS (SELECT event_id, team, count(*) FILTER (WHERE NOT schema_valid) OVER w AS failure_count,
            count(*) OVER w AS window_size FROM lg
            WINDOW w AS (PARTITION BY team ORDER BY ts, event_id ROWS BETWEEN 49 PRECEDING AND CURRENT ROW))
        SELECT event_id, team, failure_count, window_size, round(1 - failure_count::DOUBLE / window_size, 6) AS quality_rate,
               (window_size - failure_count)::DOUBLE / window_size >= 0.8 AS meets_sla FROM r""",
)
def log_rolling_quality(spark, sf):
    out = C.rolling_quality(lg(spark, sf), ["team"], last=50, sla=0.8)
    return out.select(
        "event_id", "team", "failure_count", "window_size", F.round("quality_rate", 6).alias("quality_rate"), "meets_sla"
    )


@check(
    "log_rolling_quality_1000",
    f"""WITH {LG}, r AS (SELECT event_id, count(*) FILTER (WHERE NOT schema_valid) OVER w AS failure_count,
            count(*) OVER w AS window_size FROM lg
            WINDOW w AS (PARTITION BY circuit_state ORDER BY ts, event_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW))
        SELECT event_id, failure_count, window_size FROM r""",
)
def log_rolling_quality_1000(spark, sf):
    return C.rolling_quality(lg(spark, sf), ["circuit_state"]).select("event_id", "failure_count", "window_size")


@check(
    "log_rolling_latency",
    f"""WITH {LG}, r AS (SELECT event_id, team, list_sort(list(latency_ms) OVER w) AS l, avg(latency_ms) OVER w AS rolling_mean,
            count(*) OVER w AS window_size FROM lg WHERE latency_ms IS NOT NULL
            WINDOW w AS (PARTITION BY team ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW))
        SELECT event_id, team, window_size, round(rolling_mean * window_size, 2) AS rolling_sum,
               l[CAST(floor(window_size * 0.95) AS INT) + 1] AS rolling_mark FROM r""",
)
def log_rolling_latency(spark, sf):
    out = C.rolling_latency(lg(spark, sf), ["team"], last=100)
    return out.select(
        "event_id", "team", "window_size", F.round(F.col("rolling_mean") * F.col("window_size"), 2).alias("rolling_sum"), "rolling_mark"
    )


def _token_sql(seconds: int, budget: int) -> str:
    return f"""WITH {LG}, s AS (SELECT event_id, team, coalesce(output_tokens, 0) AS own,
            sum(coalesce(output_tokens, 0)) OVER w AS used, count(*) OVER w AS calls_in_window FROM lg
            WINDOW w AS (PARTITION BY team ORDER BY ts RANGE BETWEEN INTERVAL '{seconds} seconds' PRECEDING AND CURRENT ROW))
        SELECT event_id, team, CAST(used - own AS DOUBLE) AS used_before, CAST(used - own + 150 AS DOUBLE) AS projected_use,
               used - own + 150 > {budget} AS over_budget, CAST(round(used * 100.0 / {budget}, 1) AS DOUBLE) AS utilization_pct,
               calls_in_window FROM s"""


def _token_use(spark, sf, seconds, budget):
    out = C.token_use(lg(spark, sf), ["team"], F.col("output_tokens"), seconds, budget)
    return out.select(
        "event_id", "team", "used_before", "projected_use", "over_budget", "utilization_pct", "calls_in_window"
    )


@check("log_token_use_minute", _token_sql(60, 10_000))
def log_token_use_minute(spark, sf):
    return _token_use(spark, sf, 60, 10_000)


@check("log_token_use_six_hours", _token_sql(SIX_HOURS, 500))
def log_token_use_six_hours(spark, sf):
    return _token_use(spark, sf, SIX_HOURS, 500)


@check(
    "log_failure_bursts",
    f"""WITH {LG}, f AS (SELECT event_id, team, count(*) OVER (PARTITION BY team ORDER BY ts
            RANGE BETWEEN INTERVAL '{SIX_HOURS} seconds' PRECEDING AND CURRENT ROW) AS failures FROM lg WHERE failed)
        SELECT event_id, team, failures FROM f WHERE failures >= 3""",
)
def log_failure_bursts(spark, sf):
    return C.failure_bursts(lg(spark, sf), ["team"], SIX_HOURS, 3).select("event_id", "team", "failures")


@check(
    "log_failure_incidents",
    f"""WITH {LG}, f AS (SELECT team, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL '1 hour' THEN 0 ELSE 1 END AS fresh
            FROM lg WHERE failed WINDOW w AS (PARTITION BY team ORDER BY ts)),
        g AS (SELECT *, sum(fresh) OVER (PARTITION BY team ORDER BY ts ROWS UNBOUNDED PRECEDING) AS id FROM f)
        SELECT team, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS started, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS ended, count(*) AS failures
        FROM g GROUP BY team, id""",
)
def log_failure_incidents(spark, sf):
    out = C.failure_incidents(lg(spark, sf), ["team"], 3600)
    return out.select(
        "team",
        F.date_format("started", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("started"),
        F.date_format("ended", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ended"),
        "failures",
    )


_ROLL = f"""{DAILY}, roll AS (SELECT *, CASE WHEN count(*) OVER w = 3 THEN avg(rate) OVER w END AS rolling_rate FROM daily
    WINDOW w AS (PARTITION BY team ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
  mark AS (SELECT *, coalesce(rolling_rate > 0.2, false) AS hit,
      sum(CASE WHEN coalesce(rolling_rate > 0.2, false) THEN 0 ELSE 1 END)
        OVER (PARTITION BY team ORDER BY day ROWS UNBOUNDED PRECEDING) AS island FROM roll),
  streaks AS (SELECT *, CASE WHEN hit THEN count(*) FILTER (WHERE hit)
      OVER (PARTITION BY team, island ORDER BY day ROWS UNBOUNDED PRECEDING) ELSE 0 END AS streak FROM mark)"""


@check(
    "alarm_rolling_rate",
    f"WITH {LG}, {_ROLL} SELECT team, strftime(day, '%Y-%m-%d') AS day, rate, round(rolling_rate, 6) AS rolling_rate FROM roll",
)
def alarm_rolling_rate(spark, sf):
    out = A.rolling_mean(daily_rates(spark, sf), ["team"], "day", "rate")
    return out.select(
        "team", F.date_format("day", "yyyy-MM-dd").alias("day"), "rate", F.round("rolling_rate", 6).alias("rolling_rate")
    )


@check(
    "alarm_breach_streak",
    f"WITH {LG}, {_ROLL} SELECT team, strftime(day, '%Y-%m-%d') AS day, CAST(streak AS BIGINT) AS streak FROM streaks",
)
def alarm_breach_streak(spark, sf):
    step = A.rolling_mean(daily_rates(spark, sf), ["team"], "day", "rate")
    out = A.breach_streak(step, ["team"], "day", F.col("rolling_rate") > 0.2)
    return out.select("team", F.date_format("day", "yyyy-MM-dd").alias("day"), "streak")


_COOL = f"""{_ROLL}, want AS (SELECT team, day, epoch(day) AS t FROM streaks WHERE streak >= 2),
  ordered AS (SELECT *, row_number() OVER (PARTITION BY team ORDER BY t) AS rn FROM want)"""


def _cooldown_sql(hours: int, tail: str) -> str:
    """The greedy rule as a recursive query: walk the wanting rows of a team in order."""
    return f"""WITH RECURSIVE {LG}, {_COOL}, walk AS (
          SELECT team, day, t, rn, true AS fired, t AS last FROM ordered WHERE rn = 1
          UNION ALL
          SELECT o.team, o.day, o.t, o.rn, o.t - w.last >= {hours} * 3600,
                 CASE WHEN o.t - w.last >= {hours} * 3600 THEN o.t ELSE w.last END
          FROM walk w JOIN ordered o ON o.team = w.team AND o.rn = w.rn + 1),
        done AS (SELECT s.team, s.day, s.streak, coalesce(w.fired, false) AS fired FROM streaks s LEFT JOIN walk w USING (team, day))
        {tail}"""


@check(
    "alarm_cooldown_fires",
    _cooldown_sql(72, "SELECT team, strftime(day, '%Y-%m-%d') AS day, fired FROM done"),
)
def alarm_cooldown_fires(spark, sf):
    out = A.sentiment_alarm(daily_rates(spark, sf), ["team"], "day", "rate", hours=72)
    return out.select("team", F.date_format("day", "yyyy-MM-dd").alias("day"), "fired")


@check(
    "alarm_sentiment_state",
    _cooldown_sql(
        24,
        """, lagged AS (SELECT *, coalesce(lag(fired) OVER (PARTITION BY team ORDER BY day), false) AS was FROM done)
        SELECT team, strftime(day, '%Y-%m-%d') AS day, CASE WHEN fired THEN 'ALARM' ELSE 'OK' END AS state,
               CASE WHEN fired AND NOT was THEN 'triggered' WHEN NOT fired AND was THEN 'cleared' ELSE '-' END AS transition
        FROM lagged""",
    ),
)
def alarm_sentiment_state(spark, sf):
    out = A.sentiment_alarm(daily_rates(spark, sf), ["team"], "day", "rate")
    return out.select(
        "team",
        F.date_format("day", "yyyy-MM-dd").alias("day"),
        "state",
        F.coalesce("transition", F.lit("-")).alias("transition"),
    )


def _health(spark, sf):
    """One health row per team and day. Latency is the day's maximum, freshness the hours since the
    team's last request before noon of the next day."""
    return (
        lg(spark, sf)
        .groupBy("team", F.date_trunc("day", "ts").alias("day"))
        .agg(
            F.max("latency_ms").alias("query_latency_p95_ms"),
            F.avg(F.col("schema_valid").cast("int")).alias("schema_quality_rate"),
            F.max(F.unix_timestamp("ts")).alias("last"),
        )
        .withColumn("data_freshness_hours", (F.unix_timestamp("day") + 36 * 3600 - F.col("last")) / 3600)
    )


_HEALTH = f"""{LG}, health AS (SELECT team, date_trunc('day', ts) AS day, max(latency_ms) AS lat,
    avg(CAST(schema_valid AS INT)) AS quality,
    (epoch(date_trunc('day', ts)) + 36 * 3600 - max(CAST(floor(epoch(ts)) AS BIGINT))) / 3600.0 AS fresh FROM lg GROUP BY 1, 2)"""

TEST_SIGNALS = {
    "DataFreshness": ("data_freshness_hours", "above", "Last ETL write %.1fh ago (threshold %.0fh)", 14),
    "QueryLatency": ("query_latency_p95_ms", "above", "p95 query latency %.0fms exceeds %.0fms SLA", 150),
    "SchemaQuality": ("schema_quality_rate", "below", "Schema quality %.4f%% below %.4f%% SLA", 0.8),
}


@check(
    "alarm_health_history",
    f"""WITH {_HEALTH}, sig AS (
          SELECT team, day, 'DataFreshness' AS signal, fresh > 14 AS b FROM health
          UNION ALL SELECT team, day, 'QueryLatency', lat > 150 FROM health
          UNION ALL SELECT team, day, 'SchemaQuality', quality < 0.8 FROM health),
        t AS (SELECT *, coalesce(lag(b) OVER w, false) AS was FROM sig WINDOW w AS (PARTITION BY team, signal ORDER BY day)),
        e AS (SELECT *, max(CASE WHEN b AND NOT was THEN day END)
            OVER (PARTITION BY team, signal ORDER BY day ROWS UNBOUNDED PRECEDING) AS since FROM t)
        SELECT team, signal, strftime(day, '%Y-%m-%d') AS day, CASE WHEN b THEN 'ALARM' ELSE 'OK' END AS state,
               CASE WHEN b AND NOT was THEN 'triggered' WHEN NOT b AND was THEN 'cleared' ELSE '-' END AS transition,
               CASE WHEN NOT b AND was THEN (epoch(day) - epoch(since)) / 60 ELSE 0 END AS minutes_to_clear FROM e""",
)
def alarm_health_history(spark, sf):
    out = A.health_alarms(_health(spark, sf), ["team"], "day", TEST_SIGNALS)
    return out.select(
        "team",
        "signal",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        "state",
        F.coalesce("transition", F.lit("-")).alias("transition"),
        F.coalesce("minutes_to_clear", F.lit(0.0)).alias("minutes_to_clear"),
    )


@check(
    "metrics_health_rows",
    f"""WITH {_HEALTH} SELECT team, strftime(day, '%Y-%m-%d') AS day, name, round(value, 4) AS value, unit FROM (
          SELECT team, day, 'DataFreshnessHours' AS name, CAST(fresh AS DOUBLE) AS value, 'None' AS unit FROM health
          UNION ALL SELECT team, day, 'QueryLatencyP95Ms', lat, 'None' FROM health
          UNION ALL SELECT team, day, 'SchemaQualityRate', quality, 'None' FROM health
          UNION ALL SELECT team, day, 'NegativeSentimentRatePct', (1 - quality) * 100, 'None' FROM health)""",
)
def metrics_health_rows(spark, sf):
    health = _health(spark, sf).withColumn("negative_sentiment_rate", 1 - F.col("schema_quality_rate"))
    rows = metric_rows(health, "day", HEALTH_METRICS, ["team"])
    return rows.select(
        F.col("dimensions")["team"].alias("team"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        "name",
        F.round("value", 4).alias("value"),
        "unit",
    )


@check(
    "metrics_call_rows",
    f"""WITH {LG} SELECT name, unit, count(*) AS points, round(sum(value), 2) AS total FROM (
          SELECT 'InvocationLatencyMs' AS name, 'Milliseconds' AS unit, latency_ms AS value FROM lg WHERE latency_ms IS NOT NULL
          UNION ALL SELECT 'SchemaValidationFailures', 'Count', CAST(failed AS INT) FROM lg
          UNION ALL SELECT 'CircuitBreakerOpen', 'Count', CAST(circuit_state = 'OPEN' AS INT) FROM lg
          UNION ALL SELECT 'FallbackUsed', 'Count', CAST(fallback_used AS INT) FROM lg) GROUP BY 1, 2""",
)
def metrics_call_rows(spark, sf):
    log = lg(spark, sf).withColumns(
        {
            "invalid": (~F.col("schema_valid")).cast("int"),
            "circuit_open": (F.col("circuit_state") == "OPEN").cast("int"),
            "fallback_used": F.col("fallback_used").cast("int"),
        }
    )
    rows = metric_rows(log, "ts", CALL_METRICS, ["team"])
    return rows.groupBy("name", "unit").agg(
        F.count(F.lit(1)).alias("points"), F.round(F.sum("value"), 2).alias("total")
    )
