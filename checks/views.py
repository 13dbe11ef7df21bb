"""Conversation views over the given tables, once as DataFrames and once as SQL for the oracle.

``ins``: one insight row per order. ``kw``/``tp``: complaint keywords and raw topics per order.
``lg``: call log, one row per event. ``calls``: call records with a transcript made of fixed phrases
per order, so that the default word lists have hits. ``docs``: documents as calls. ``meta``: account
metadata per customer, in two versions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions.rules import empty_insight_with
from parley.plans.insights import publish_insights
from parley.settings import work_folder

KEYWORDS = {"R": "below_target_roas", "A": "high_cpc"}
KEYWORD_ELSE = "budget_exhaustion"
TOPICS = [
    "roas_optimization",
    "budget_management",
    "targeting_strategy",
    "campaign_structure",
    "bidding_optimization",
    "competitor_analysis",
    "feature_request",
    "reporting_analytics",
    "cpc_reduction",
    "conversion_rate",
    "ad spend",
    "Unknown",
]
CAMPAIGNS = ["Sponsored_Products", "Sponsored_Brands", "Sponsored_Display"]

# Phrases by remainder of the order key; an absent remainder adds nothing.
PHRASES = [
    (4, {0: "Our ROAS is great", 1: "We had an issue with the budget", 2: "Reporting is down and we struggle"}),
    (5, {0: "thank you for the success", 1: "I suggest auto bidding", 3: "the problem is a broken campaign"}),
    (7, {2: "Google Ads performs better.", 3: "CPC and impression share fail", 5: "excellent targeting, happy"}),
    (11, {4: "conversion is frustrated by this fail", 6: "we would love the metadata", 9: "great improved"}),
    (3, {1: "down &amp; down", 2: "price &lt; cost"}),
]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _pick(col, choices: dict, otherwise=None):
    expr = F.lit(otherwise)
    for key, value in choices.items():
        expr = F.when(col == key, value).otherwise(expr)
    return expr


def _sql_case(expr: str, choices: dict, otherwise: str = "NULL") -> str:
    quoted = " ".join(f"WHEN {k} THEN '{v}'" for k, v in choices.items())
    return f"CASE {expr} {quoted} ELSE {otherwise} END"


def _adv(col: str):
    return F.concat(F.lit("adv_"), F.lpad(F.col(col).cast("string"), 5, "0"))


def _conv(col: str):
    return F.concat(F.lit("conv_"), F.lpad(F.col(col).cast("string"), 8, "0"))


def ins(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(*[c.alias(name) for name, c in _ins_columns().items()])


def _ins_columns() -> dict[str, Column]:
    """What ``ins`` derives from the columns of an order."""
    key = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    return {
        "o_orderkey": key,
        "conversation_id": _conv("o_orderkey"),
        "advertiser_id": _adv("o_custkey"),
        "call_date": day,
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "team": F.concat(F.lit("Team_"), F.char(65 + F.col("o_custkey") % 18)),
        "campaign_type": _pick(key % 3, dict(enumerate(CAMPAIGNS))),
        "sentiment": _pick(F.col("o_orderstatus"), {"F": "positive", "O": "neutral"}, "negative"),
        "urgency": _pick(
            F.substring("o_orderpriority", 1, 1), {"1": "seasonal_pressure", "2": "high", "3": "medium", "5": "low"}
        ),
        "roas_sentiment": _pick(key % 5, {1: "positive", 2: "neutral", 3: "negative", 4: "mixed"}),
        "resolution_type": _pick(key % 4, {0: "full_resolution", 1: "partial_resolution", 2: "escalated"}),
        "has_action": key % 7 < 3,
        "schema_valid": key % 1000 != 0,
    }


INS = f"""ins AS (SELECT o_orderkey,
    concat('conv_', lpad(CAST(o_orderkey AS VARCHAR), 8, '0')) AS conversation_id,
    concat('adv_', lpad(CAST(o_custkey AS VARCHAR), 5, '0')) AS advertiser_id,
    CAST(o_orderdate AS DATE) AS call_date, CAST(year(o_orderdate) AS INT) AS year,
    CAST(month(o_orderdate) AS INT) AS month, CAST(day(o_orderdate) AS INT) AS day,
    concat('Team_', chr(CAST(65 + o_custkey % 18 AS INT))) AS team,
    {_sql_case('o_orderkey % 3', dict(enumerate(CAMPAIGNS)))} AS campaign_type,
    CASE o_orderstatus WHEN 'F' THEN 'positive' WHEN 'O' THEN 'neutral' ELSE 'negative' END AS sentiment,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'seasonal_pressure' WHEN '2' THEN 'high'
         WHEN '3' THEN 'medium' WHEN '5' THEN 'low' END AS urgency,
    {_sql_case('o_orderkey % 5', {1: 'positive', 2: 'neutral', 3: 'negative', 4: 'mixed'})} AS roas_sentiment,
    {_sql_case('o_orderkey % 4', {0: 'full_resolution', 1: 'partial_resolution', 2: 'escalated'})} AS resolution_type,
    o_orderkey % 7 < 3 AS has_action, o_orderkey % 1000 <> 0 AS schema_valid FROM orders)"""


WORDS = [*KEYWORDS.values(), KEYWORD_ELSE]


def _bits(place: Column) -> Column:
    """Places, from 0, of all rows of a group."""
    return F.coalesce(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))), F.lit(0).cast("long"))


def _set_of(names: list[str], bits: Column) -> Column:
    """Names whose bits are set. A fixed list travels as one number, and no set is collected per order."""
    all_names = F.array(*[F.lit(n) for n in names])
    return F.when(bits.isNotNull(), F.filter(all_names, lambda _, i: F.getbit(bits, i) == 1))


def _word_place() -> Column:
    return _pick(F.col("l_returnflag"), {k: i for i, k in enumerate(KEYWORDS)}, len(KEYWORDS))


def _topic_place() -> Column:
    return F.col("l_partkey") % len(TOPICS)


def keywords(spark: SparkSession, sf: str) -> DataFrame:
    """Complaint keywords per order as an array (at most three values)."""
    failed = table(spark, sf, "lineitem").where("l_linestatus = 'F'")
    bits = failed.groupBy("l_orderkey").agg(_bits(_word_place()).alias("words"))
    return bits.select("l_orderkey", _set_of(WORDS, F.col("words")).alias("keywords"))


KW = f"""kw AS (SELECT DISTINCT l_orderkey, {_sql_case('l_returnflag', {f"'{k}'": v for k, v in KEYWORDS.items()}, f"'{KEYWORD_ELSE}'")} AS keyword
    FROM lineitem WHERE l_linestatus = 'F')"""


def topics(spark: SparkSession, sf: str) -> DataFrame:
    """Raw topics per order as an array (at most twelve values)."""
    bits = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(_bits(_topic_place()).alias("places"))
    return bits.select("l_orderkey", _set_of(TOPICS, F.col("places")).alias("topics"))


TP = f"""tp AS (SELECT DISTINCT l_orderkey, {_sql_case('l_partkey % 12', dict(enumerate(TOPICS)))} AS topic FROM lineitem)"""


def _orders_with_bits(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as they are, with the bits of their topics and keywords; what ``ins`` derives is not shuffled."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    words = _bits(F.when(F.col("l_linestatus") == "F", _word_place()))
    bits = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        _bits(_topic_place()).alias("places"), words.alias("words")
    )
    return orders.join(bits, "o_orderkey", "left")


def insights_with_lists(spark: SparkSession, sf: str) -> DataFrame:
    """``ins`` with keyword and topic arrays; orders without any have NULL."""
    lists = [_set_of(TOPICS, F.col("places")).alias("topics"), _set_of(WORDS, F.col("words")).alias("keywords")]
    return _orders_with_bits(spark, sf).select(*[c.alias(name) for name, c in _ins_columns().items()], *lists)


_CATALOG: dict[tuple[str, str], str] = {}


def insight_records(orders: DataFrame) -> DataFrame:
    """Nested insight records of ``_orders_with_bits``, with complaint keywords; columns that are there stay."""
    derived = {name: c for name, c in _ins_columns().items() if name not in orders.columns}
    base = orders.withColumns({**derived, "keywords": _set_of(WORDS, F.col("words"))})
    none = F.array().cast("array<string>")
    spec = {
        "callAnalysis": {"overallSentiment": F.col("sentiment"), "urgencyLevel": F.col("urgency"), "resolutionType": F.col("resolution_type")},
        "campaignStructure": {"primaryCampaignType": F.col("campaign_type")},
        "complaintAnalysis": {"complaintKeywords": F.coalesce("keywords", none)},
        "performanceMetricsSentiment": {
            "roasSentiment": F.col("roas_sentiment"),
            "roasSentimentAdvertiser": F.col("sentiment"),
            "advertiserPerception": F.col("urgency"),
        },
    }
    return base.withColumn("insight", empty_insight_with(spec))


def insight_catalog(spark: SparkSession, sf: str) -> str:
    """Name of the catalog table of nested insight records, partitioned by day; published once per session and input."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _CATALOG:
        name = f"insights_{uuid.uuid4().hex[:12]}"
        rows = _orders_with_bits(spark, sf)
        # seven years of days hold so few rows here that one task would write all of their files
        small = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
        before = spark.conf.get(small)
        spark.conf.set(small, "1k")
        publish_insights(
            rows,
            name,
            work_folder(spark, "insights"),
            F.col("o_orderdate").cast("date"),
            keep=["conversation_id", "advertiser_id"],
            derive=insight_records,
        )
        spark.conf.set(small, before)
        _CATALOG[key] = name
    return _CATALOG[key]


def lg(spark: SparkSession, sf: str) -> DataFrame:
    error = F.col("event_type") == "error"
    return table(spark, sf, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("Team_"), F.char(65 + F.col("user_id") % 18)).alias("team"),
        error.alias("failed"),
        (~error).alias("schema_valid"),
        (F.col("event_id") % 50 == 0).alias("fallback_used"),
        F.when(F.col("event_id") % 200 == 0, "OPEN").otherwise("CLOSED").alias("circuit_state"),
        F.col("value").alias("latency_ms"),
        F.get_json_object("props", "$.k").cast("int").alias("output_tokens"),
    )


LG = """lg AS (SELECT event_id, ts, concat('Team_', chr(CAST(65 + user_id % 18 AS INT))) AS team,
    event_type = 'error' AS failed, event_type <> 'error' AS schema_valid, event_id % 50 = 0 AS fallback_used,
    CASE WHEN event_id % 200 = 0 THEN 'OPEN' ELSE 'CLOSED' END AS circuit_state, value AS latency_ms,
    CAST(json_extract_string(props, '$.k') AS INT) AS output_tokens FROM events)"""


def calls(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    parts = [_pick(key % mod, words) for mod, words in PHRASES]
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice").select(
        "o_orderkey",
        "o_custkey",
        _conv("o_orderkey").alias("conversation_id"),
        _adv("o_custkey").alias("advertiser_id"),
        F.floor("o_totalprice").cast("int").alias("duration_seconds"),
        F.slice(
            F.array(
                F.struct(F.lit("customer").alias("role"), F.lit(40).alias("talk_time")),
                F.struct(F.lit("rep").alias("role"), F.lit(60).alias("talk_time")),
            ),
            F.lit(1),
            (key % 3).cast("int"),
        ).alias("participants"),
        F.concat_ws(" ", *parts).alias("transcript"),
    )


CALLS = """calls AS (SELECT o_orderkey, o_custkey,
    concat('conv_', lpad(CAST(o_orderkey AS VARCHAR), 8, '0')) AS conversation_id,
    concat('adv_', lpad(CAST(o_custkey AS VARCHAR), 5, '0')) AS advertiser_id,
    CAST(floor(o_totalprice) AS INT) AS duration_seconds, CAST(o_orderkey % 3 AS INT) AS people,
    concat_ws(' ', {parts}) AS transcript FROM orders)""".format(
    parts=", ".join(_sql_case(f"o_orderkey % {mod}", words) for mod, words in PHRASES)
)


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.col("doc_id"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("conversation_id"),
        F.col("n_chars").cast("int").alias("duration_seconds"),
        F.array(F.struct(F.col("lang").alias("role")), F.struct(F.col("source").alias("role"))).alias("participants"),
        F.col("text").alias("transcript"),
    )


DOCS = """docs AS (SELECT doc_id, concat('doc_', CAST(doc_id AS VARCHAR)) AS conversation_id,
    CAST(n_chars AS INT) AS duration_seconds, lang, source, text AS transcript FROM documents)"""


def meta(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions per customer, the second with another stage; every fourth customer has an empty
    key, so its calls find no metadata."""
    row = table(spark, sf, "customer").select(
        F.when(F.col("c_custkey") % 4 == 0, "").otherwise(F.col("c_custkey").cast("string")).alias("conversation_id"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")).alias("account_name"),
        F.col("c_mktsegment").alias("opportunity_stage"),
        F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("M"), F.col("c_nationkey").cast("string"))).alias(
            "marketplace_id"
        ),
        F.lit(1).alias("version"),
    )
    second = row.withColumn("version", F.lit(2)).withColumn("opportunity_stage", F.lower("opportunity_stage"))
    return row.unionAll(second)


META = """meta1 AS (SELECT CASE WHEN c_custkey % 4 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS conversation_id,
    CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS account_name, c_mktsegment AS opportunity_stage,
    CASE WHEN c_nationkey % 2 = 0 THEN concat('M', CAST(c_nationkey AS VARCHAR)) END AS marketplace_id, 1 AS version
    FROM customer),
  meta AS (SELECT * FROM meta1 UNION ALL
    SELECT conversation_id, account_name, lower(opportunity_stage), marketplace_id, 2 FROM meta1)"""


def daily_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Share of failed requests per team and day: the daily negative rate of the alarm checks."""
    return (
        lg(spark, sf)
        .groupBy("team", F.date_trunc("day", "ts").alias("day"))
        .agg(F.round(F.avg(F.col("failed").cast("int")), 6).alias("rate"))
    )


DAILY = """daily AS (SELECT team, date_trunc('day', ts) AS day, round(avg(CAST(failed AS INT)), 6) AS rate
    FROM lg GROUP BY ALL)"""
