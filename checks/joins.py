"""Joins, lookup and key profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from checks.views import LG, META, calls, ins, keywords, lg, meta, table
from checks.views import CALLS, INS, KW
from parley.operators import joins


def _customer_calls(spark, sf):
    """Calls keyed by customer, so that several calls meet one metadata row."""
    return calls(spark, sf).withColumn("conversation_id", F.col("o_custkey").cast("string"))


_ENRICHED = f"""{META}, latest AS (SELECT * FROM meta WHERE conversation_id <> '' AND version = 2), {CALLS}"""


@check(
    "join_enrich_calls",
    f"""WITH {_ENRICHED} SELECT o_orderkey, coalesce(account_name, '') AS account_name, opportunity_stage,
        coalesce(marketplace_id, 'US') AS marketplace_id, 'standard' AS advertiser_tier, people AS participant_count,
        true AS ingestion_enriched,
        replace(replace(replace(transcript, '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS transcript
        FROM calls JOIN latest ON latest.conversation_id = CAST(o_custkey AS VARCHAR)""",
)
def join_enrich_calls(spark, sf):
    out = joins.enrich_calls(_customer_calls(spark, sf), meta(spark, sf), ["version"])
    return out.select(
        "o_orderkey",
        "account_name",
        "opportunity_stage",
        "marketplace_id",
        "advertiser_tier",
        "participant_count",
        "ingestion_enriched",
        "transcript",
    )


@check(
    "join_latest_metadata",
    f"WITH {META} SELECT conversation_id, opportunity_stage, version FROM meta WHERE conversation_id <> '' AND version = 2",
)
def join_latest_metadata(spark, sf):
    return joins.latest_by_key(meta(spark, sf), "conversation_id", ["version"]).select(
        "conversation_id", "opportunity_stage", "version"
    )


@check(
    "join_lookup_dimension",
    """WITH dim AS (SELECT c_custkey % 50 AS bucket, arg_max(c_mktsegment, c_custkey) AS vertical,
            arg_max(CAST(c_nationkey AS VARCHAR), c_custkey) AS tier FROM customer GROUP BY 1)
        SELECT o_orderkey, coalesce(vertical, 'unknown') AS advertiser_vertical, coalesce(tier, 'standard') AS advertiser_tier
        FROM orders LEFT JOIN dim ON o_orderkey % 60 = bucket""",
)
def join_lookup_dimension(spark, sf):
    """Calls fall into 60 buckets and the dimension covers 50 of them."""
    dim = table(spark, sf, "customer").select(
        (F.col("c_custkey") % 50).alias("bucket"),
        F.col("c_mktsegment").alias("vertical"),
        F.col("c_nationkey").cast("string").alias("tier"),
        "c_custkey",
    )
    out = joins.lookup_dimension(table(spark, sf, "orders"), dim, F.col("o_orderkey") % 60, ["c_custkey"])
    return out.select("o_orderkey", "advertiser_vertical", "advertiser_tier")


def _skewed(spark, sf):
    """Events of which a third belong to one customer."""
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("user_id"))
    return table(spark, sf, "events").select("event_id", hot.cast("bigint").alias("c_custkey"), "value")


_SKEW = """skewed AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS c_custkey, value FROM events)"""


@check(
    "join_salted",
    f"""WITH {_SKEW} SELECT c_mktsegment, count(*) AS n, round(sum(value), 2) AS total
        FROM skewed JOIN customer USING (c_custkey) GROUP BY ALL""",
)
def join_salted(spark, sf):
    out = joins.salted_join(_skewed(spark, sf), table(spark, sf, "customer"), "c_custkey", F.col("event_id"))
    return out.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")
    )


@check(
    "join_explode_keywords",
    f"WITH {INS}, {KW} SELECT conversation_id, keyword FROM ins JOIN kw ON o_orderkey = l_orderkey",
)
def join_explode_keywords(spark, sf):
    base = ins(spark, sf).select("conversation_id", "o_orderkey")
    lists = base.join(keywords(spark, sf), base.o_orderkey == F.col("l_orderkey"), "left")
    return lists.select("conversation_id", F.explode("keywords").alias("keyword"))


@check(
    "profile_hot_keys",
    f"""WITH {_SKEW} SELECT c_custkey AS key, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM skewed), 6) AS share
        FROM skewed GROUP BY 1 ORDER BY n DESC, key LIMIT 10""",
)
def profile_hot_keys(spark, sf):
    return joins.key_profile(_skewed(spark, sf), "c_custkey")


@check(
    "profile_team_load",
    f"""WITH {LG} SELECT team AS key, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM lg), 6) AS share
        FROM lg GROUP BY 1 ORDER BY n DESC, key LIMIT 5""",
)
def profile_team_load(spark, sf):
    return joins.key_profile(lg(spark, sf), "team", 5)
