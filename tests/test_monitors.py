import datetime as dt

import pytest
from pyspark.sql import functions as F

from parley.operators.joins import salted_join
from parley.plans.alarms import fired_with_cooldown
from parley.operators.scan import exact_percentiles, with_rank
from parley.plans import alarms as A
from parley.plans import calllog as C
from parley.plans.dashboard import kpis
from parley.plans.reports import run_report
from parley.plans.rollup import entity_key, rollup

START = dt.datetime(2024, 1, 1)


def log(spark, rows):
    """rows: (seconds, valid, tokens)"""
    data = [(i, START + dt.timedelta(seconds=s), "t", ok, not ok, tok, float(i)) for i, (s, ok, tok) in enumerate(rows)]
    return spark.createDataFrame(
        data,
        "event_id long, ts timestamp, team string, schema_valid boolean, failed boolean, output_tokens int, latency_ms double",
    )


def days(spark, rates, step_hours=24):
    data = [("k", START + dt.timedelta(hours=step_hours * i), r) for i, r in enumerate(rates)]
    return spark.createDataFrame(data, "k string, day timestamp, rate double")


def test_rolling_alarm_fires_on_the_fourth_row(spark):
    rows = A.sentiment_alarm(days(spark, [0.25, 0.30, 0.35, 0.35]), ["k"], "day", "rate").orderBy("day").collect()
    assert [r.rolling_rate and round(r.rolling_rate, 4) for r in rows] == [None, None, 0.3, 0.3333]
    assert [r.streak for r in rows] == [0, 0, 1, 2]
    assert [r.fired for r in rows] == [False, False, False, True]
    assert rows[3].state == "ALARM" and rows[3].transition == "triggered"


def test_streak(spark):
    hits = [0, 0, 1, 1, 1, 0, 0, 1, 1, 0]
    df = A.breach_streak(days(spark, [float(h) for h in hits]), ["k"], "day", F.col("rate") > 0.5)
    assert [r.streak for r in df.orderBy("day").collect()] == [0, 0, 1, 2, 3, 0, 0, 1, 2, 0]


def test_cooldown(spark):
    data = [("k", START + dt.timedelta(hours=h)) for h in (0, 10, 30)]
    df = spark.createDataFrame(data, "k string, ts timestamp")
    fired = A.fired_with_cooldown(df, ["k"], "ts", F.lit(True)).orderBy("ts").collect()
    assert [r.fired for r in fired] == [True, False, True]


def test_alarm_is_cleared_while_cooling_down(spark):
    df = days(spark, [0.5] * 8, step_hours=6)
    rows = A.sentiment_alarm(df, ["k"], "day", "rate").orderBy("day").collect()
    assert [r.state for r in rows] == ["OK"] * 3 + ["ALARM"] + ["OK"] * 3 + ["ALARM"]
    assert [r.transition for r in rows][3:] == ["triggered", "cleared", None, None, "triggered"]


def test_health_alarm_reports_duration(spark):
    data = [("x", START + dt.timedelta(minutes=5 * i), h, 100.0, 1.0) for i, h in enumerate([1.0, 26.0, 27.0, 2.0])]
    df = spark.createDataFrame(
        data,
        "svc string, ts timestamp, data_freshness_hours double, query_latency_p95_ms double, schema_quality_rate double",
    )
    rows = A.health_alarms(df, ["svc"], "ts").where("signal = 'DataFreshness'").orderBy("ts").collect()
    assert [r.transition for r in rows] == [None, "triggered", None, "cleared"]
    assert rows[1].reason == "Last ETL write 26.0h ago (threshold 25h)" and rows[3].minutes_to_clear == 10.0


@pytest.mark.parametrize("flags, rate, meets", [([True] * 999 + [False], 0.999, True), ([True] * 98 + [False] * 2, 0.98, False)])
def test_rolling_quality(spark, flags, rate, meets):
    df = C.rolling_quality(log(spark, [(i, ok, 0) for i, ok in enumerate(flags)]), ["team"])
    last = df.orderBy(F.desc("event_id")).first()
    assert round(last.quality_rate, 6) == rate and last.meets_sla == meets and last.window_size == len(flags)


@pytest.mark.parametrize("spread", [100_000, 1])
def test_rolling_windows_match_brute_force_over_many_blocks(spark, spread):
    """Spread over time, and all at one instant."""
    import random

    rng = random.Random(7)
    rows = [(rng.randrange(spread), rng.random() > 0.3, rng.randrange(100)) for _ in range(1000)]
    df = log(spark, rows).withColumn("latency_ms", F.round(F.rand(3) * 100, 2)).cache()
    local = sorted(df.collect(), key=lambda r: (r.ts, r.event_id))
    quality = {r.event_id: r.failure_count for r in C.rolling_quality(df, ["team"], last=40).collect()}
    latency = {r.event_id: r for r in C.rolling_latency(df, ["team"], last=40).collect()}
    used_frame = C.token_use(df, ["team"], F.col("output_tokens"), 900)
    tokens = {r.event_id: r.used_before for r in used_frame.collect()}
    minute = F.floor(F.unix_timestamp("ts") / 60)
    ranked = with_rank(df, ["team"], ["ts", "event_id"], minute)
    ranks = {r.event_id: r["rank"] for r in ranked.collect()}
    for i, row in enumerate(local):
        window = local[max(0, i - 39) : i + 1]
        assert quality[row.event_id] == sum(r.failed for r in window)
        ordered = sorted(r.latency_ms for r in window)
        assert latency[row.event_id].rolling_mark == ordered[int(len(ordered) * 0.95)]
        assert abs(latency[row.event_id].rolling_mean - sum(ordered) / len(ordered)) < 1e-9
        used = sum(r.output_tokens for r in local[:i] if (row.ts - r.ts).total_seconds() <= 900)
        assert tokens[row.event_id] == used
        assert ranks[row.event_id] == i + 1


def test_tokens_exactly_one_window_old_still_count(spark):
    df = C.token_use(log(spark, [(0, True, 7), (60, True, 1), (121, True, 1)]), ["team"], F.col("output_tokens"))
    assert [r.used_before for r in df.orderBy("event_id").collect()] == [0.0, 7.0, 0.0]


def test_failure_bursts_and_incidents(spark):
    df = log(spark, [(i * 2, False, 0) for i in range(12)] + [(22 + 30, False, 0), (22 + 61, False, 0), (500, True, 0)])
    assert C.failure_bursts(df, ["team"]).count() == 4
    got = [(r.failures, (r.ended - r.started).total_seconds()) for r in C.failure_incidents(df, ["team"]).orderBy("started").collect()]
    assert got == [(13, 52.0), (1, 0.0)]


@pytest.mark.parametrize("n, value", [(100, 95), (200, 190), (1, 0), (20, 19)])
def test_percentile_position(spark, n, value):
    df = spark.range(n).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"))
    assert exact_percentiles(df, "v", ["g"], [0.95]).first().value == value
    assert exact_percentiles(df, "v", [], [0.95]).first().value == value


def test_percentiles_match_sorting_with_ties_signs_and_a_hot_group(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        F.when(F.col("id") % 4 == 0, 0.0).otherwise(F.round(F.randn(11) * 1000, 1)).alias("v"),
    ).cache()
    groups = {}
    for r in df.collect():
        groups.setdefault(r.g, []).append(r.v)
    for r in exact_percentiles(df, "v", ["g"], [0.0, 0.25, 0.5, 0.99]).collect():
        assert r.value == sorted(groups[r.g])[int(len(groups[r.g]) * r.point)]


def test_salted_join_equals_plain_join(spark):
    left = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("k"), "id")
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = left.join(right, "k").select("k", "id", "v")
    salted = salted_join(left, right, "k", F.col("id"), 7).select("k", "id", "v")
    assert plain.exceptAll(salted).isEmpty() and salted.exceptAll(plain).isEmpty()


def test_entity_key_falls_back(spark):
    df = spark.createDataFrame(
        [("", "conv_000123"), ("adv_1", "x"), (None, "")],
        "advertiser_id string, cid string",
    ).select("advertiser_id", F.struct(F.col("cid").alias("conversation_id")).alias("metadata"))
    assert [r.k for r in df.select(entity_key(df).alias("k")).collect()] == ["conv_000123", "adv_1", "unknown"]


def test_rollup_reads_the_old_flat_layout(spark):
    schema = (
        "advertiser_id string, nlp_features struct<sentiment_score: double, sentiment_label: string, "
        "advanced_analysis: struct<key_topics: array<string>>>"
    )
    rows = [("a", (0.5, "positive", (["roas", "cpc"],))), ("a", (None, None, (None,))), ("a", (-1.0, "odd", (["cpc"],)))]
    row = rollup(spark.createDataFrame(rows, schema), "2024-01-01").first()
    assert row.call_count == 3 and row.concern_count == 2 and row.avg_sentiment_score == -0.1667
    assert row.sentiment_counts.asDict() == {"positive": 1, "neutral": 1, "negative": 0}
    assert row.sentiment_label == "negative" and len(row.improvement_suggestions) == 4


def test_kpis_of_nothing(spark):
    df = spark.createDataFrame([], "sentiment string, schema_valid boolean")
    assert tuple(kpis(df).first()) == (0, 0.0, None)


def test_unknown_report_names_the_choices(spark):
    with pytest.raises(ValueError, match="daily_sentiment_trend"):
        run_report(spark, "nope", "t", 2024)
    with pytest.raises(ValueError, match="month"):
        run_report(spark, "daily_sentiment_trend", "t", 2024)


def test_null_groups_nan_and_missing_times_keep_their_rows(spark):
    values = [float(x) for x in range(-5, 5)] + [float("nan")] * 5
    df = spark.createDataFrame([(None, v) for v in values], "g string, v double")
    got = C.latency_distribution(df, "v", ["g"], [0.5]).first()
    assert (got.g, got.calls, got.p50) == (None, 15, 2.0)
    rows = [(None if i == 3 else f"2024-01-0{i % 2 + 1} 00:00:0{i}", f"e{i}", i % 2 == 0) for i in range(6)]
    log = spark.createDataFrame(rows, "ts string, event_id string, schema_valid boolean")
    log = log.withColumn("ts", F.to_timestamp("ts")).withColumn("team", F.lit(None).cast("string"))
    got = {r.event_id: (r.window_size, r.failure_count) for r in C.rolling_quality(log, ["team"], last=40).collect()}
    assert got == {"e3": (1, 1), "e0": (2, 1), "e2": (3, 1), "e4": (4, 1), "e1": (5, 2), "e5": (6, 3)}


def test_of_equal_times_one_fires_and_null_is_a_key(spark):
    rows = [(k, f"2024-01-01 {h:02d}:00:00", i) for k in (None, "a") for i, h in enumerate((0, 0, 2, 4, 9))]
    df = spark.createDataFrame(rows, "k string, ts string, i int").withColumn("ts", F.to_timestamp("ts"))
    got = fired_with_cooldown(df, ["k"], "ts", F.lit(True), 4).where("fired").collect()
    assert sorted((r.k or "", r.i) for r in got) == [(k, i) for k in ("", "a") for i in (0, 3, 4)]


def test_foreign_buckets_do_not_reach_the_lookup_and_only_hot_keys_are_salted(spark):
    from parley.operators.joins import lookup_dimension, salted_join

    dim = spark.range(-5, 1000).selectExpr("id AS bucket", "'v' AS vertical", "'t' AS tier", "1 AS version")
    got = lookup_dimension(spark.range(60).withColumnRenamed("id", "x"), dim, F.col("x"), ["version"])
    assert {r.x: r.advertiser_vertical for r in got.collect()} == {x: "v" if x < 50 else "unknown" for x in range(60)}
    left = spark.range(3000).selectExpr("if(id < 1000, 0, id) AS k", "id AS n")
    right = spark.range(0, 3000, 2).selectExpr("id AS k", "id AS m")
    got = salted_join(left, right, "k", F.col("n")).groupBy().agg(F.count("*").alias("c"), F.sum("m").alias("s")).first()
    assert (got.c, got.s) == (2000, sum(range(1000, 3000, 2)))
