import datetime as dt
import gzip
import uuid

import pytest
from pyspark.sql import functions as F

from parley.settings import PROFILES, work_folder
from parley.sources import tables
from parley.sources.calls import bad_lines, read_call_exports
from parley.sources.landing import marketplace_of
from parley.streaming import ingest


def test_files_of_any_size_are_read_and_broken_lines_kept_apart(spark, tmp_path):
    line = '{"conversation_id": "c%d", "duration_seconds": %s, "transcript": "%s"}\n'
    body = "".join(line % (i, "5", uuid.uuid4().hex) for i in range(60))
    (tmp_path / "big.gz").write_bytes(gzip.compress((body + "\n\nnot json\n" + line % (70, '"long"', "x")).encode()))
    (tmp_path / "small.gz").write_bytes(gzip.compress((line % (99, "5", "x")).encode()))
    (tmp_path / "other.json").write_text(body)
    calls = read_call_exports(spark, str(tmp_path))
    assert calls.count() == 61
    assert len(calls.select("conversation_id").collect()) == len(calls.select("duration_seconds", "transcript").collect()) == 61
    bad = bad_lines(spark, str(tmp_path)).collect()
    assert len(bad) == 2 and all(r.file.endswith("big.gz") for r in bad)


def test_marketplace_rule(spark):
    df = spark.createDataFrame(
        [("UK", [("customer",)]), ("", [("customer",)]), (None, [])],
        "marketplace_id string, participants array<struct<role: string>>",
    )
    assert [r.m for r in df.select(marketplace_of(df).alias("m")).collect()] == ["UK", "US", "US"]
    roles = df.select(marketplace_of(df, role_fallback=True).alias("m")).collect()
    assert [r.m for r in roles] == ["UK", "customer", "US"]


def test_rewriting_a_day_keeps_the_others_and_twice_is_once(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, 2024, 1, 1), (2, 2024, 1, 2)], "id int, year int, month int, day int")
    tables.write_partitions(rows, path)
    for _ in range(2):
        tables.write_partitions(rows.where("day = 2").withColumn("id", F.lit(9)), path)
    assert sorted((r.id, r.day) for r in spark.read.parquet(path).collect()) == [(1, 1), (9, 2)]


def test_partitions_are_pruned_and_columns_listed(spark, tmp_path):
    path, name = str(tmp_path / "t"), "insights_listing"
    rows = spark.createDataFrame([("a", 1.0, 2024, 1, 1), ("b", 2.0, 2024, 1, 2)], "k string, v double, year int, month int, day int")
    tables.write_partitions(rows, path)
    tables.register_table(spark, name, path, rows.schema)
    listed = [tuple(r) for r in tables.table_columns(spark, name).collect()]
    assert listed == [("k", "string", False), ("v", "double", False)] + [(p, "int", True) for p in ("year", "month", "day")]
    plan = spark.table(name).where("year = 2024 AND day = 2").select("k")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "ReadSchema: struct<k:string>" in plan


def test_work_folder_follows_the_session(spark):
    assert work_folder(spark, "x") != work_folder(spark, "x")
    assert set(PROFILES) == {"tuned", "baseline"}


def test_replayed_ingest_lands_every_call_once(spark, tmp_path):
    calls = spark.range(50).select(
        F.concat(F.lit("c"), F.col("id") % 40).alias("conversation_id"),
        (F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("ts"),
    )
    calls.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        stream = ingest.file_stream(spark, str(tmp_path / "in"), calls.schema)
        ingest.ingest_calls(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 40


def exchanged(df):
    """Column names that go through a shuffle or a broadcast anywhere in the plan."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    blocks = [b for b in plan.split("\n\n") if " Exchange\n" in b or "BroadcastExchange\n" in b]
    return blocks, {name.split("#")[0].strip(" []") for b in blocks for line in b.split("\n") if line.startswith("Input") for name in line.split(":", 1)[1].split(",")}


@pytest.fixture
def day(spark):
    calls = spark.range(300).select(
        F.concat(F.lit("c"), F.col("id")).alias("conversation_id"),
        F.concat(F.lit("a"), F.col("id") % 7).alias("advertiser_id"),
        F.concat(F.lit("a great budget &amp; roas call "), F.col("id")).alias("transcript"),
        F.lit(5).alias("duration_seconds"),
    )
    meta = spark.range(600).select(
        F.concat(F.lit("c"), F.col("id") % 200).alias("conversation_id"), F.col("id").cast("string").alias("account_name"), F.col("id").alias("version")
    )
    dim = spark.range(50).select(F.col("id").alias("bucket"), F.lit("v").alias("vertical"), F.lit("t").alias("tier"), F.lit(1).alias("version"))
    return calls, meta, dim


def test_no_transcript_is_shuffled_by_the_daily_job(spark, day):
    from parley.operators.joins import enrich_calls
    from parley.plans.daily import day_features

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = day_features(*day, 0)
    blocks, names = exchanged(rows)
    whole = exchanged(enrich_calls(day[0], day[1], ["version"]))[1]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert blocks and "conversation_id" in names and "transcript" not in names and "transcript" in whole
    found = {r.conversation_id: r.account_name for r in rows.select("conversation_id", "account_name").collect()}
    assert found == {f"c{i}": str(400 + i) for i in range(200)}


def test_bucketed_tables_are_joined_without_a_shuffle(spark, day, tmp_path):
    from parley.operators.joins import with_accounts
    from parley.plans.features import feature_record

    for name, df in zip(("calls_bucketed", "meta_bucketed"), day, strict=False):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        tables.write_buckets(df, name, "conversation_id", 4, str(tmp_path / name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    features = feature_record(spark.table("calls_bucketed"), 0, keep=("conversation_id", "advertiser_id"))
    joined = with_accounts(features, spark.table("meta_bucketed"), ["version"])
    blocks, _ = exchanged(joined)
    rows = {r.conversation_id: r.account_name for r in joined.select("conversation_id", "account_name").collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not blocks and rows == {f"c{i}": str(400 + i) for i in range(200)}


def test_the_last_metadata_row_counts(spark, tmp_path):
    from parley.operators.joins import latest_by_key
    from parley.sources.calls import read_metadata

    line = '{"conversation_id": "%s", "account_name": "%s"}\n'
    (tmp_path / "b.json").write_text(line % ("x", "first") + line % ("x", "second") + line % ("y", "old"))
    import os

    os.utime(tmp_path / "b.json", (1_600_000_000, 1_600_000_000))
    (tmp_path / "a.json").write_text(line % ("y", "new"))
    latest = latest_by_key(read_metadata(spark, str(tmp_path)), "conversation_id", ["version"])
    assert {r.conversation_id: r.account_name for r in latest.collect()} == {"x": "second", "y": "new"}


def test_one_scan_gives_calls_and_quarantine(spark, tmp_path):
    from parley.sources.calls import read_split, split_exports

    good, bad = '{"conversation_id": "c%d", "duration_seconds": 5}\n', "not json %d\n"
    (tmp_path / "in").mkdir()
    for f in range(3):
        (tmp_path / "in" / f"{f}.gz").write_bytes(gzip.compress("".join([good % f, bad % f, "\n", bad % f]).encode()))
    for _ in range(2):
        assert split_exports(spark, str(tmp_path / "in"), str(tmp_path / "out")) == {"calls": 3, "broken": 6}
    calls, broken = read_split(spark, str(tmp_path / "out"))
    assert sorted(r.conversation_id for r in calls.collect()) == ["c0", "c1", "c2"]
    assert sorted((r.file[-4:], r.line, r.n) for r in broken.collect()) == [(f"{f}.gz", f"not json {f}", 2) for f in range(3)]


def test_parts_of_the_feature_run_follow_the_input(spark, sf, monkeypatch):
    from checks import sources
    from parley.sources.metrics import write_with_run_metrics

    def run(df, folder):
        seen.append(df.rdd.getNumPartitions())
        return write_with_run_metrics(df, folder)

    seen, aqe = [], "spark.sql.adaptive."
    monkeypatch.setattr(sources, "write_with_run_metrics", run)
    for advised in ("64m", "4k"):
        small = {"advisoryPartitionSizeInBytes": advised, "coalescePartitions.minPartitionSize": "1k", "coalescePartitions.parallelismFirst": "false"}
        for key, value in small.items():
            spark.conf.set(aqe + key, value)
        row = sources.run_metrics(spark, sf).first()
        for key in small:
            spark.conf.unset(aqe + key)
        assert row.record_count == row.rows_written == 1500 and row.same_partitions
    # five parts of any table before
    assert seen[0] == 1 and seen[1] > 5
