"""Rollup per advertiser and topic flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.features import _any, _scored, _tags, topic_sql
from checks.registry import check
from checks.views import CALLS, INS, TP, calls, insights_with_lists
from parley.functions import vocabulary as V
from parley.plans import flows as FL
from parley.plans.features import feature_record
from parley.plans.rollup import concern_lists, entity_concerns, entity_key, entity_measures, rollup
from parley.plans.throughput import compare_profiles


def _features(spark, sf):
    """Features of all calls; those of every tenth customer carry no advertiser."""
    base = calls(spark, sf)
    adv = F.when(F.col("o_custkey") % 10 == 0, "").otherwise(F.col("advertiser_id"))
    return feature_record(base.withColumn("advertiser_id", adv), 0)


_ENTITY = f"""{CALLS}, {_scored('calls', V.POSITIVE_WORDS, V.NEGATIVE_WORDS)},
  ent AS (SELECT *, CASE WHEN o_custkey % 10 = 0 THEN conversation_id ELSE advertiser_id END AS entity_id,
          round(score, 4) AS s FROM lab)"""

_MEASURES = """m AS (SELECT entity_id, count(*) AS call_count, avg(s) AS mean, CAST(sum(CAST(round(s * 10000) AS BIGINT)) AS BIGINT) AS k,
    count(*) FILTER (WHERE label = 'positive') AS positive, count(*) FILTER (WHERE label = 'neutral') AS neutral,
    count(*) FILTER (WHERE label = 'negative') AS negative FROM ent GROUP BY 1)"""

_CONCERNS = f"""con AS (SELECT entity_id, c AS concern, count(*) AS mentions FROM (
    SELECT entity_id, unnest(string_split(CASE WHEN t = '' THEN 'general' ELSE t END, '|')) AS c
      FROM (SELECT entity_id, {_tags('low', V.TOPIC_TAGS)} AS t FROM ent)
    UNION ALL
    SELECT entity_id, unnest(string_split(p, '|')) FROM (SELECT entity_id, {_tags('low', V.PAIN_TAGS)} AS p FROM ent) WHERE p <> ''
  ) GROUP BY ALL)"""


@check(
    "rollup_entity_key",
    f"WITH {_ENTITY} SELECT entity_id, count(*) AS n FROM ent GROUP BY 1",
)
def rollup_entity_key(spark, sf):
    f = _features(spark, sf)
    return f.groupBy(entity_key(f).alias("entity_id")).agg(F.count(F.lit(1)).alias("n"))


@check(
    "rollup_measures",
    f"""WITH {_ENTITY}, {_MEASURES} SELECT entity_id, call_count, sign(k) * ((2 * abs(k) + call_count) // (2 * call_count)) / 10000.0 AS avg_sentiment_score,
        CASE WHEN k > 1000 * call_count THEN 'positive' WHEN k < -1000 * call_count THEN 'negative' ELSE 'neutral' END AS sentiment_label,
        positive, neutral, negative, negative::DOUBLE / call_count AS negative_rate FROM m""",
)
def rollup_measures(spark, sf):
    return entity_measures(_features(spark, sf)).select(
        "entity_id", "call_count", "avg_sentiment_score", "sentiment_label", "sentiment_counts.*", "negative_rate"
    )


@check("rollup_concerns", f"WITH {_ENTITY}, {_CONCERNS} SELECT entity_id, concern, mentions FROM con")
def rollup_concerns(spark, sf):
    return entity_concerns(_features(spark, sf))


@check(
    "rollup_concern_lists",
    f"""WITH {_ENTITY}, {_CONCERNS}, n AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY mentions DESC, concern) AS n FROM con)
        SELECT entity_id, string_agg(concern, '|' ORDER BY concern) AS concerns FROM n WHERE n <= 3 GROUP BY 1""",
)
def rollup_concern_lists(spark, sf):
    lists = concern_lists(entity_concerns(_features(spark, sf)), 3)
    return lists.select("entity_id", F.array_join("concerns", "|").alias("concerns"))


def _suggestion_sql() -> str:
    rules = [f"CASE WHEN {_any('text', terms)} THEN '{advice}' END" for terms, advice in V.SUGGESTIONS]
    rules.append(f"CASE WHEN k < -1000 * call_count THEN '{V.SUGGEST_OUTREACH}' END")
    rules.append(f"CASE WHEN call_count >= 3 THEN '{V.SUGGEST_TREND}' END")
    joined = f"array_to_string(list_filter([{', '.join(rules)}], lambda x: x IS NOT NULL), '|')"
    return f"CASE WHEN {joined} = '' THEN '{V.SUGGEST_NONE}' ELSE {joined} END"


@check(
    "rollup_with_suggestions",
    f"""WITH {_ENTITY}, {_MEASURES}, {_CONCERNS},
        list AS (SELECT entity_id, count(*) AS concern_count, string_agg(DISTINCT concern, '|' ORDER BY concern) AS concerns FROM con GROUP BY 1),
        j AS (SELECT m.*, concern_count, concerns, lower(replace(concerns, '|', ' ')) AS text FROM m JOIN list USING (entity_id))
        SELECT entity_id, call_count, concerns, concern_count, {_suggestion_sql()} AS suggestions, '2024-01-31' AS rollup_date FROM j""",
)
def rollup_with_suggestions(spark, sf):
    return rollup(_features(spark, sf), "2024-01-31", lists=True).select(
        "entity_id",
        "call_count",
        F.array_join("concerns", "|").alias("concerns"),
        "concern_count",
        F.array_join("improvement_suggestions", "|").alias("suggestions"),
        "rollup_date",
    )


def _records(spark, sf):
    """Records in four spellings by order: either analysis with camelCase or with snake_case names.

    Every eleventh has no label in its analysis and falls back to the record's own one.
    """
    base = insights_with_lists(spark, sf)
    key = F.col("o_orderkey")
    label = F.when(key % 11 != 0, F.col("sentiment"))

    def analysis(camel: int, snake: int):
        """Both spellings side by side; those of other orders are NULL."""
        pairs = [(camel, "overallSentiment", "primaryTopics"), (snake, "overall_sentiment", "primary_topics")]
        fields = [x for n, a, b in pairs for x in (F.when(key % 4 == n, label).alias(a), F.when(key % 4 == n, F.col("topics")).alias(b))]
        return F.struct(*fields)

    insights = F.struct(analysis(0, 2).alias("callAnalysis"), F.struct(F.col("campaign_type").alias("primaryCampaignType")).alias("campaignStructure"))
    features = F.struct(F.struct(analysis(3, 1).alias("call_analysis")).alias("advanced_analysis"))
    own = F.when(key % 3 != 0, F.col("campaign_type")).otherwise("")
    return base.select(
        "conversation_id",
        own.alias("campaign_type"),
        F.when(key % 11 == 0, "dissatisfied").alias("sentiment"),
        insights.alias("processed_insights"),
        features.alias("nlp_features"),
    )


_FLOW = f"""{INS}, {TP}, mention AS (SELECT campaign_type, {topic_sql('lower(topic)')} AS topic,
      CASE WHEN o_orderkey % 11 = 0 THEN 'positive' ELSE sentiment END AS sentiment
    FROM ins JOIN tp ON o_orderkey = l_orderkey WHERE topic <> 'Unknown'),
  flow AS (SELECT topic, sentiment, count(*) AS mentions FROM mention GROUP BY ALL)"""


@check("flow_topic_sentiment", f"WITH {_FLOW} SELECT topic, sentiment, mentions FROM flow")
def flow_topic_sentiment(spark, sf):
    return FL.topic_flows(_records(spark, sf))


@check(
    "flow_campaign_filter",
    f"""WITH {_FLOW} SELECT topic, sentiment, count(*) AS mentions FROM mention
        WHERE campaign_type IN ('Sponsored_Display', 'Sponsored_Brands') GROUP BY ALL""",
)
def flow_campaign_filter(spark, sf):
    return FL.topic_flows(_records(spark, sf), campaigns=["sponsored display", "Brand"])


@check(
    "flow_totals",
    f"""WITH {_FLOW} SELECT CASE WHEN topic IS NOT NULL AND sentiment IS NOT NULL THEN 'flow'
               WHEN topic IS NOT NULL THEN 'topic' ELSE 'sentiment' END AS level,
               topic, sentiment, CAST(sum(mentions) AS BIGINT) AS mentions
        FROM flow GROUP BY GROUPING SETS ((topic, sentiment), (topic), (sentiment))""",
)
def flow_totals(spark, sf):
    return FL.flow_totals(FL.topic_flows(_records(spark, sf)))


_TOPICS = "per AS (SELECT topic, CAST(sum(mentions) AS BIGINT) AS mentions FROM flow GROUP BY 1)"


@check(
    "flow_top_topics",
    f"""WITH {_FLOW}, {_TOPICS}, lead AS (SELECT topic FROM per ORDER BY mentions DESC, topic LIMIT 5)
        SELECT topic, sentiment, mentions FROM flow WHERE topic IN (SELECT topic FROM lead)""",
)
def flow_top_topics(spark, sf):
    return FL.flows_of_top_topics(FL.topic_flows(_records(spark, sf)), 5)


@check(
    "flow_topic_table",
    f"""WITH {_FLOW}, {_TOPICS} SELECT topic, mentions,
        CAST(round(mentions * 100.0 / (SELECT sum(mentions) FROM per), 1) AS DOUBLE) AS pct
        FROM per ORDER BY mentions DESC, topic LIMIT 8""",
)
def flow_topic_table(spark, sf):
    return FL.topic_table(FL.topic_flows(_records(spark, sf)))


@check(
    "flow_sentiment_table",
    f"""WITH {_FLOW}, want AS (SELECT unnest([0, 1, 2]) AS position, unnest(['positive', 'neutral', 'negative']) AS sentiment),
        s AS (SELECT sentiment, sum(mentions) AS n FROM flow GROUP BY 1)
        SELECT CAST(position AS INT) AS position, sentiment, CAST(coalesce(n, 0) AS BIGINT) AS mentions,
               CAST(round(coalesce(n, 0) * 100.0 / (SELECT sum(n) FROM s), 1) AS DOUBLE) AS pct
        FROM want LEFT JOIN s USING (sentiment)""",
)
def flow_sentiment_table(spark, sf):
    return FL.sentiment_table(FL.topic_flows(_records(spark, sf)))


@check(
    "flow_leading_topics",
    f"""WITH {_FLOW}, r AS (SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY mentions DESC, topic) AS rn
            FROM flow WHERE sentiment IN ('positive', 'negative'))
        SELECT sentiment, topic, mentions FROM r WHERE rn = 1""",
)
def flow_leading_topics(spark, sf):
    return FL.leading_topics(FL.topic_flows(_records(spark, sf)))


@check(
    "throughput_profiles",
    f"""WITH {_ENTITY}, n AS (SELECT count(DISTINCT entity_id) AS n FROM ent)
        SELECT unnest(['baseline', 'tuned']) AS profile, n AS records, true AS measured FROM n""",
)
def throughput_profiles(spark, sf):
    """The rollup under both profiles; times vary, so only the row counts can be compared."""
    here = {"spark.sql.shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions")}
    out = compare_profiles(spark, lambda: rollup(_features(spark, sf), "2024-01-31"), runs=1, overrides=here)
    return out.select("profile", "records", (F.col("records_per_second") > 0).alias("measured"))
