"""Streams against their batch jobs: any order of arrival, late rows, and what is open at the end of the input."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from parley.plans.alarms import sentiment_alarm
from parley.streaming import ingest, monitors

SCHEMA = "k string, day timestamp, rate double"
START = dt.datetime(2024, 1, 1)


def write_batches(spark, folder, batches):
    """A file for each list of (key, day number, rate), which file order makes a micro-batch each."""
    for rows in batches:
        data = [(k, None if d is None else START + dt.timedelta(days=d), r) for k, d, r in rows]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def alarm_rows(df):
    cols = ["key", "day", "rolling_rate", "streak", "fired"]
    return sorted((tuple(None if x is None else round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(cols).collect()), key=str)


def run_alarm(spark, folder, path, **options):
    stream = ingest.file_stream(spark, path, SCHEMA, per_trigger=1)
    return ingest.run_to_end(stream, lambda d: monitors.sentiment_alarm_stream(d, "k", **options), folder, "day")


def test_days_shuffled_over_micro_batches_give_the_batch_result(spark, tmp_path):
    rng = random.Random(7)
    rows = [(k, d, None if rng.random() < 0.05 else round(rng.uniform(0, 0.5), 3)) for k in ("a", "b", "c") for d in range(40) if rng.random() < 0.9]
    rng.shuffle(rows)
    batches = [rows[i::6] for i in range(6)]
    write_batches(spark, str(tmp_path / "in"), batches)
    out = run_alarm(spark, str(tmp_path / "run"), str(tmp_path / "in"), hours=72, lateness="50 days").cache()
    assert out.where("late").count() == 0 and out.count() == len(rows)
    batch = sentiment_alarm(spark.read.parquet(str(tmp_path / "in")), ["k"], "day", "rate", hours=72)
    assert alarm_rows(out) == alarm_rows(batch.withColumnRenamed("k", "key"))
    assert out.where("fired").count() > 3


def test_late_days_are_marked_and_change_nothing(spark, tmp_path):
    first = [("a", d, 0.3) for d in range(10)]
    # the greatest day is 9: with two days of lateness, day 3 is late and day 8 is not
    late = [("a", 3, 0.9), ("a", 8, 0.3), ("a", None, 0.5), ("b", 9, 0.1)]
    write_batches(spark, str(tmp_path / "in"), [first, late, [("a", 30, 0.1)]])
    out = run_alarm(spark, str(tmp_path / "run"), str(tmp_path / "in")).cache()
    marked = [(r.day and (r.day - START).days, r.fired) for r in out.where("late").collect()]
    assert sorted(marked, key=str) == [(3, False), (None, False)]
    kept = spark.createDataFrame([(k, START + dt.timedelta(days=d), r) for k, d, r in [*first, *[x for x in late if x[1] in (8, 9)], ("a", 30, 0.1)]], SCHEMA)
    batch = sentiment_alarm(kept, ["k"], "day", "rate").withColumnRenamed("k", "key")
    days = lambda df: sorted((r.key, r.day, r.rolling_rate) for r in df.collect() if r.rolling_rate is not None)
    assert days(out.where("NOT late")) == days(batch)


def test_a_quiet_key_is_released_by_its_timer(spark, tmp_path):
    write_batches(spark, str(tmp_path / "in"), [[("quiet", d, 0.4) for d in range(5)], [("busy", 40, 0.1)], [("busy", 41, 0.1)]])
    stream = ingest.file_stream(spark, str(tmp_path / "in"), SCHEMA, per_trigger=1)
    out = ingest.run_to_files(monitors.sentiment_alarm_stream(stream, "k"), str(tmp_path / "run"))
    assert sorted((r.day - START).days for r in out.where("key = 'quiet'").collect()) == [0, 1, 2, 3, 4]
    assert [(r.day - START).days for r in out.where("fired").collect()] == [3, 4]


@pytest.fixture
def log(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, START + dt.timedelta(seconds=rng.randint(0, 4000)), f"t{rng.randint(0, 2)}", rng.random() < 0.3, 5) for i in range(600)]
    schema = "event_id long, ts timestamp, team string, failed boolean, output_tokens int"
    df = spark.createDataFrame(rows, schema).withColumn("schema_valid", ~F.col("failed"))
    df.repartition(4).write.parquet(str(tmp_path / "log"))
    return str(tmp_path / "log"), df


def test_windows_open_at_the_end_are_closed(spark, log, tmp_path):
    path, df = log
    batch = {
        "quality": df.groupBy(F.window("ts", "5 minutes").start.alias("s")).agg(F.count("*").alias("n")),
        "load": df.groupBy("team", F.window("ts", "60 seconds", "10 seconds").start.alias("s")).agg(F.count_if("failed").alias("n")),
        "incidents": df.where("failed").groupBy("team", F.session_window("ts", "30 seconds").alias("w")).agg(F.count("*").alias("n")).select("w.start", "n"),
    }
    jobs = {
        "quality": (monitors.quality_windows, "window_start", "calls"),
        "load": (monitors.team_load, "window_start", "failures"),
        "incidents": (monitors.incident_windows, "started", "failures"),
    }
    for name, (job, start, count) in jobs.items():
        # rows come in any order within two hours
        stream = ingest.file_stream(spark, path, df.schema, per_trigger=1)
        whole = lambda rows, job=job: job(rows, lateness="2 hours")
        out = ingest.run_to_end(stream, whole, str(tmp_path / name), closing_values={"failed": True})
        got = sorted((r[start], r[count]) for r in out.collect())
        assert got == sorted((r[-2], r[-1]) for r in batch[name].collect()), name


def test_landing_writes_few_files_per_partition(spark, tmp_path):
    rows = [(f"c{i % 400}", START + dt.timedelta(hours=(i % 400) % 48), ("US", "UK")[i % 2]) for i in range(800)]
    calls = spark.createDataFrame(rows, "conversation_id string, ts timestamp, marketplace_id string")
    calls.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = ingest.file_stream(spark, str(tmp_path / "in"), calls.schema)
    ingest.ingest_calls(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    landed = spark.read.parquet(str(tmp_path / "out"))
    assert landed.count() == 400 and landed.select("conversation_id").distinct().count() == 400
    # four partitions; each of the eight state partitions wrote to all of them before
    assert len(list((tmp_path / "out").rglob("*.parquet"))) == 4
