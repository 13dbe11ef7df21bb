"""Readers, sinks and the catalog. Each query writes what it derives from the tables to a fresh work
folder and reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.registry import check
from checks.views import CALLS, LG, calls, docs, ins, insight_catalog, lg, meta, table
from checks.views import INS, META
from parley.functions import vocabulary as V
from parley.functions.rules import rule_insight
from parley.plans.daily import run_day
from parley.plans.features import feature_record
from parley.plans.rollup import rollup
from parley.settings import work_folder
from parley.sources import landing, tables
from parley.sources.calls import read_call_exports, read_metadata, read_split, split_exports, typed_calls
from parley.sources.metrics import CALL_METRICS, metric_rows, write_metrics, write_with_run_metrics


def _as_calls(spark, sf):
    """Documents as call records; each has a marketplace, one in seven has none."""
    market = F.when(F.col("doc_id") % 7 != 0, F.element_at(F.array(*[F.lit(m) for m in ("US", "UK", "DE")]), (F.col("doc_id") % 3 + 1).cast("int")))
    return docs(spark, sf).select(
        "doc_id", "conversation_id", "duration_seconds", "participants", "transcript", market.alias("marketplace_id")
    )


_MARKET = "CASE WHEN doc_id % 7 <> 0 THEN CASE doc_id % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'UK' ELSE 'DE' END END"


@check(
    "source_call_exports",
    """SELECT concat('doc_', CAST(doc_id AS VARCHAR)) AS conversation_id, CAST(n_chars AS INT) AS duration_seconds,
        md5(text) AS transcript FROM documents WHERE doc_id % 17 <> 0""",
)
def source_call_exports(spark, sf):
    read = read_call_exports(spark, _exports(spark, sf))
    return read.select("conversation_id", "duration_seconds", F.md5("transcript").alias("transcript"))


@check(
    "source_bad_lines",
    """SELECT concat('{"conversation_id": "broken ', CAST(doc_id AS VARCHAR)) AS line, CAST(1 AS BIGINT) AS n,
        (SELECT count(*) FROM documents WHERE doc_id % 17 <> 0) AS calls, (SELECT count(*) FROM documents WHERE doc_id % 17 = 0) AS broken,
        true AS same_rows FROM documents WHERE doc_id % 17 = 0""",
)
def source_bad_lines(spark, sf):
    """Calls and broken lines of one scan; the counts are those of the write."""
    out = work_folder(spark, "split")
    counts = split_exports(spark, _exports(spark, sf), out)
    good, bad = read_split(spark, out)
    same = good.agg((F.count(F.lit(1)) == counts["calls"]).alias("same")).scalar()
    return bad.where(F.col("file").endswith(".gz")).select(
        "line", "n", *[F.lit(counts[c]).cast("long").alias(c) for c in ("calls", "broken")], same.alias("same_rows")
    )


def _exports(spark, sf):
    """Gzipped JSON lines with broken and blank lines in between, and a directory of plain files."""
    folder = work_folder(spark, "exports")
    lines = _as_calls(spark, sf).select(
        F.when(F.col("doc_id") % 17 == 0, F.concat(F.lit('{"conversation_id": "broken '), F.col("doc_id").cast("string")))
        .otherwise(
            F.to_json(F.struct("conversation_id", "duration_seconds", "participants", "transcript", "marketplace_id"))
        )
        .alias("value"),
        F.when(F.col("doc_id") % 5 == 0, F.lit("")).alias("blank"),
    )
    text = lines.select(F.explode(F.array_compact(F.array("value", "blank"))).alias("value")).hint("rebalance")
    text.write.option("compression", "gzip").text(f"{folder}/part=gz")
    text.write.text(f"{folder}/part=plain")
    return folder


@check(
    "source_account_metadata",
    f"""WITH {META} SELECT conversation_id, account_name, opportunity_stage, marketplace_id FROM meta""",
)
def source_account_metadata(spark, sf):
    folder = work_folder(spark, "metadata")
    meta(spark, sf).drop("version").write.json(folder)
    return read_metadata(spark, folder).select("conversation_id", "account_name", "opportunity_stage", "marketplace_id")


@check(
    "source_typed_calls",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN CAST(year(o_orderdate) AS INT) ELSE 0 END AS year,
        CASE WHEN o_orderkey % 10 <> 0 THEN CAST(day(o_orderdate) AS INT) ELSE 0 END AS day FROM orders""",
)
def source_typed_calls(spark, sf):
    text = F.when(F.col("o_orderkey") % 10 == 0, "no date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    typed = typed_calls(table(spark, sf, "orders").select("o_orderkey", text.alias("call_date")))
    return typed.select(
        "o_orderkey",
        F.coalesce(F.year("call_date"), F.lit(0)).alias("year"),
        F.coalesce(F.dayofmonth("call_date"), F.lit(0)).alias("day"),
    )


@check(
    "landing_manifest",
    f"""WITH d AS (SELECT doc_id, concat('doc_', CAST(doc_id AS VARCHAR)) AS conversation_id, {_MARKET} AS m, text FROM documents)
        SELECT 'calls' AS bucket, concat('raw/', coalesce(m, 'US'), '/date=2024-02-01/', conversation_id, '.json') AS key,
          CAST(octet_length(encode(concat('{{"conversation_id":"', conversation_id, '",',
               CASE WHEN m IS NULL THEN '' ELSE concat('"marketplace_id":"', m, '",') END, '"transcript":',
               CAST(to_json(text) AS VARCHAR), '}}'))) AS INT) AS size_bytes FROM d""",
)
def landing_manifest(spark, sf):
    c = _as_calls(spark, sf).select("conversation_id", "marketplace_id", "transcript")
    return landing.landing_manifest(c, "calls", "2024-02-01")


@check(
    "landing_write",
    f"""SELECT coalesce({_MARKET}, 'en') AS marketplace, '2024-02-01' AS date, count(*) AS calls, CAST(sum(n_chars) AS BIGINT) AS seconds
        FROM documents GROUP BY 1""".replace("'en'", "lang"),
)
def landing_write(spark, sf):
    """Calls without a marketplace land under the first participant's role here."""
    folder = work_folder(spark, "landing")
    landing.write_landing(_as_calls(spark, sf), folder, "2024-02-01", role_fallback=True)
    landing.write_landing(_as_calls(spark, sf), folder, "2024-02-01", role_fallback=True)
    back = spark.read.schema("conversation_id string, duration_seconds int, marketplace string, date string").json(folder)
    return back.groupBy("marketplace", "date").agg(
        F.count(F.lit(1)).alias("calls"), F.sum("duration_seconds").alias("seconds")
    )


def _daily_insights(spark, sf):
    day = F.col("ts")
    return lg(spark, sf).select(
        "event_id", "team", "latency_ms", F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day")
    )


@check(
    "table_partition_overwrite",
    f"""WITH {LG} SELECT CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day, count(*) AS n,
        CASE WHEN day(ts) % 2 = 0 THEN 'second' ELSE 'first' END AS run FROM lg GROUP BY ALL""",
)
def table_partition_overwrite(spark, sf):
    """The second run holds the even days only: it replaces those and leaves the others."""
    folder = work_folder(spark, "insights")
    rows = _daily_insights(spark, sf)
    tables.write_partitions(rows.withColumn("run", F.lit("first")), folder)
    tables.write_partitions(rows.where("day % 2 = 0").withColumn("run", F.lit("second")), folder)
    return (
        spark.read.parquet(folder)
        .groupBy("year", "month", "day", "run")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@check(
    "table_register_and_discover",
    f"""WITH {LG} SELECT CAST(day(ts) AS INT) AS day, count(*) AS n, CAST(count(*) * (day(ts) <= 15)::INT AS BIGINT) AS n_before FROM lg GROUP BY day(ts)""",
)
def table_register_and_discover(spark, sf):
    """Partitions written after the registration are seen only after a discovery."""
    folder = work_folder(spark, "catalog")
    name = f"insights_{uuid.uuid4().hex[:10]}"
    rows = _daily_insights(spark, sf)
    tables.write_partitions(rows.where("day <= 15"), folder)
    tables.register_table(spark, name, folder, rows.schema)
    tables.write_partitions(rows.where("day > 15"), folder)
    seen = work_folder(spark, "seen")
    spark.table(name).groupBy("day").agg(F.count(F.lit(1)).alias("n_before")).write.parquet(seen)
    tables.discover_partitions(spark, name)
    after = spark.table(name).groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    return after.join(spark.read.parquet(seen), "day", "left").select(
        "day", "n", F.coalesce("n_before", F.lit(0)).alias("n_before")
    )


@check(
    "table_flatten_insights",
    f"""WITH {CALLS}, low AS (SELECT o_orderkey, advertiser_id, lower(transcript) AS low FROM calls)
        SELECT advertiser_id, 'v1.2' AS processing_version, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
        CAST(day(o_orderdate) AS INT) AS day,
        CASE WHEN contains(low, 'roas') THEN 'negative' ELSE 'neutral' END AS performancemetricssentiment_roassentiment,
        CASE WHEN contains(low, 'roas') THEN 'below_target_roas' ELSE '' END AS complaintanalysis_complaintkeywords,
        CASE WHEN contains(low, 'roas') THEN 'Performance Metrics' ELSE 'Budget Optimization' END AS callanalysis_primarytopics,
        CASE WHEN contains(low, 'budget') THEN 'limited' ELSE 'good' END AS campaignscale_scaleperception,
        contains(low, 'budget') AS campaignscale_scaleissuesreported,
        CASE WHEN contains(low, 'budget') THEN 'budget_limited' ELSE '-' END AS budgetandbidding_budgetutilization, CAST(66 AS INT) AS n_columns
        FROM low JOIN orders USING (o_orderkey)""",
)
def table_flatten_insights(spark, sf):
    day = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("call_day"))
    base = calls(spark, sf).join(day, "o_orderkey").withColumns(
        {"insight": rule_insight(F.col("transcript"), V.KEYWORD_RULES), "processing_version": F.lit("v1.2")}
    )
    flat = tables.flatten_insights(base, "insight", F.col("call_day"), ["advertiser_id", "processing_version"])
    return flat.select(
        "advertiser_id",
        "processing_version",
        "year",
        "month",
        "day",
        "performancemetricssentiment_roassentiment",
        F.array_join("complaintanalysis_complaintkeywords", "|").alias("complaintanalysis_complaintkeywords"),
        F.array_join("callanalysis_primarytopics", "|").alias("callanalysis_primarytopics"),
        "campaignscale_scaleperception",
        "campaignscale_scaleissuesreported",
        F.coalesce("budgetandbidding_budgetutilization", F.lit("-")).alias("budgetandbidding_budgetutilization"),
        F.lit(len(flat.columns)).alias("n_columns"),
    )


@check(
    "table_columns",
    """SELECT * FROM (VALUES ('advertiser_id', 'string', false), ('year', 'int', true),
        ('month', 'int', true), ('day', 'int', true), ('callanalysis_primarytopics', 'array<string>', false),
        ('campaignscale_scaleissuesreported', 'boolean', false), ('budgetandbidding_dailybudget', 'double', false))
        AS t(name, type, is_partition)""",
)
def table_columns(spark, sf):
    """Names, types and partition flags of the registered insights table, one column of each kind."""
    kinds = ["advertiser_id", "year", "month", "day", "callanalysis_primarytopics", "campaignscale_scaleissuesreported", "budgetandbidding_dailybudget"]
    return tables.table_columns(spark, insight_catalog(spark, sf)).where(F.col("name").isin(kinds))


@check(
    "table_rollup_sink",
    f"""WITH {CALLS}, d AS (SELECT unnest(['2024-01-30', '2024-01-31']) AS rollup_date)
        SELECT rollup_date, count(DISTINCT advertiser_id) AS entities, count(*) AS calls FROM calls, d GROUP BY 1""",
)
def table_rollup_sink(spark, sf):
    """Two dates, the later one written twice."""
    folder = work_folder(spark, "rollups")
    features = feature_record(calls(spark, sf), 0)
    for date in ("2024-01-30", "2024-01-31", "2024-01-31"):
        tables.write_rollup(rollup(features, date), folder)
    return (
        spark.read.parquet(folder)
        .groupBy(F.col("rollup_date").cast("string").alias("rollup_date"))
        .agg(F.count(F.lit(1)).alias("entities"), F.sum("call_count").alias("calls"))
    )


@check(
    "metrics_sink",
    f"""WITH {LG} SELECT team, 'InvocationLatencyMs' AS name, count(latency_ms) AS points,
        CAST(count(latency_ms) FILTER (WHERE day(ts) % 2 = 0) AS BIGINT) AS points_of_even_days FROM lg GROUP BY team""",
)
def metrics_sink(spark, sf):
    """The points of odd and of even days as two runs, each written twice."""
    folder = work_folder(spark, "metrics")
    rows = metric_rows(lg(spark, sf).select("ts", "team", "latency_ms"), "ts", CALL_METRICS, ["team"])
    for run in ("odd", "even", "odd", "even"):
        write_metrics(rows.where(F.dayofmonth("ts") % 2 == int(run == "odd")), folder, run)
    return (
        spark.read.parquet(folder)
        .groupBy(F.col("dimensions")["team"].alias("team"), "name")
        .agg(F.count(F.lit(1)).alias("points"), F.count_if(F.col("run") == "even").alias("points_of_even_days"))
    )


@check("run_metrics", "SELECT count(*) AS record_count, count(*) AS rows_written, true AS took_time, true AS same_partitions FROM orders")
def run_metrics(spark, sf):
    """Record count of a feature run, taken while it writes.

    The calls are dealt in parts of the advised size, so a task reads no more of a larger table.
    """
    folder = work_folder(spark, "run")
    m = write_with_run_metrics(feature_record(calls(spark, sf).hint("rebalance"), 0), folder)
    return spark.read.parquet(folder).select(F.col("_metadata.file_path").alias("file")).agg(
        F.lit(m["record_count"]).cast("bigint").alias("record_count"),
        F.count(F.lit(1)).alias("rows_written"),
        F.lit(m["elapsed_seconds"] > 0).alias("took_time"),
        # a partition with rows writes a file, and here every one has rows
        (F.count_distinct("file") == m["partition_count"]).alias("same_partitions"),
    )


@check(
    "daily_run",
    f"""WITH {CALLS}, {META}, latest AS (SELECT * FROM meta WHERE conversation_id <> '' AND version = 2)
        SELECT advertiser_id AS entity_id, count(*) AS call_count, '2024-01-31' AS rollup_date,
               (SELECT count(*) FROM calls JOIN latest ON latest.conversation_id = CAST(o_custkey AS VARCHAR)) AS record_count
        FROM calls JOIN latest ON latest.conversation_id = CAST(o_custkey AS VARCHAR) GROUP BY 1""",
)
def daily_run(spark, sf):
    """Calls keyed by customer through the whole day, twice, and the rollup that results."""
    folder = work_folder(spark, "day")
    keyed = calls(spark, sf).withColumn("conversation_id", F.col("o_custkey").cast("string"))
    dim = table(spark, sf, "customer").select(
        (F.col("c_custkey") % 50).alias("bucket"),
        F.col("c_mktsegment").alias("vertical"),
        F.lit("premium").alias("tier"),
        F.col("c_custkey").alias("version"),
    )
    for _ in range(2):
        m = run_day(keyed, meta(spark, sf), dim, folder, "2024-01-31", 0)
    return spark.read.parquet(f"{folder}/rollup").select(
        "entity_id",
        "call_count",
        F.col("rollup_date").cast("string").alias("rollup_date"),
        F.lit(m["record_count"]).cast("bigint").alias("record_count"),
    )
