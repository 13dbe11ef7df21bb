"""Text features, prompts and rule insights."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from checks.views import CALLS, DOCS, INS, TP, calls, docs, ins, table, topics
from parley.functions import prompts as P
from parley.functions import text as X
from parley.functions import vocabulary as V
from parley.functions.rules import derived_fields, rule_insight
from parley.plans.features import feature_record


def _in(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def _any(column: str, terms) -> str:
    return "(" + " OR ".join(f"contains({column}, '{t}')" for t in terms) + ")"


def _tags(column: str, tag_map) -> str:
    items = ", ".join(f"CASE WHEN contains({column}, '{k}') THEN '{v}' END" for k, v in tag_map.items())
    return f"array_to_string(list_filter([{items}], lambda x: x IS NOT NULL), '|')"


def _tokens(column: str) -> str:
    return f"list_filter(string_split_regex({column}, '\\s+'), lambda x: x <> '')"


def _scored(source: str, positive, negative) -> str:
    """CTEs with tokens, hits, score and label over a view."""
    return f"""tok AS (SELECT *, lower(transcript) AS low, {_tokens('lower(transcript)')} AS words FROM {source}),
      hit AS (SELECT *, len(list_filter(words, lambda w: w IN {_in(positive)})) AS pos,
                     len(list_filter(words, lambda w: w IN {_in(negative)})) AS neg FROM tok),
      sc AS (SELECT *, CAST(pos - neg AS DOUBLE) / greatest(pos + neg, 1) AS score FROM hit),
      lab AS (SELECT *, CASE WHEN score > 0.1 THEN 'positive' WHEN score < -0.1 THEN 'negative' ELSE 'neutral' END AS label,
              CASE WHEN neg > 3 THEN 'high' WHEN neg > 1 THEN 'medium' ELSE 'low' END AS pressure FROM sc)"""


@check(
    "fea_metadata",
    f"""WITH {DOCS} SELECT conversation_id, duration_seconds, CAST(2 AS INT) AS participant_count,
        CAST(len({_tokens('transcript')}) AS INT) AS word_count FROM docs""",
)
def fea_metadata(spark, sf):
    return feature_record(docs(spark, sf), 0).select("metadata.*")


@check(
    "fea_flags",
    f"""WITH {CALLS}, low AS (SELECT conversation_id, lower(transcript) AS low FROM calls)
        SELECT conversation_id, {_any('low', V.PRICING_TERMS)} AS pricing_mentioned,
               {_any('low', V.COMPETITOR_TERMS)} AS competitor_mentioned,
               {_any('low', V.REQUEST_TERMS)} AS feature_request_identified FROM low""",
)
def fea_flags(spark, sf):
    return feature_record(calls(spark, sf), 0).select("metadata.conversation_id", "business_features.*")


@check(
    "fea_flags_whole_word",
    r"""WITH """
    + CALLS
    + r""" SELECT conversation_id, regexp_matches(lower(transcript), '\b(?:google ads|meta|microsoft advertising|trade desk)\b')
        AS competitor_mentioned FROM calls""",
)
def fea_flags_whole_word(spark, sf):
    return feature_record(calls(spark, sf), 0, word_boundary=True).select(
        "metadata.conversation_id", "business_features.competitor_mentioned"
    )


@check(
    "fea_lexicon_sentiment",
    f"""WITH {CALLS}, {_scored('calls', V.POSITIVE_WORDS, V.NEGATIVE_WORDS)}
        SELECT conversation_id, round(score, 4) AS sentiment_score, label AS sentiment_label, pressure AS urgency,
               pos > neg AS call_resolution, neg > 2 AS follow_up_required FROM lab""",
)
def fea_lexicon_sentiment(spark, sf):
    f = feature_record(calls(spark, sf), 0)
    c = "nlp_features.advanced_analysis.call_analysis"
    return f.select(
        "metadata.conversation_id",
        "nlp_features.sentiment_score",
        "nlp_features.sentiment_label",
        f"{c}.urgency",
        f"{c}.call_resolution",
        f"{c}.follow_up_required",
    )


TEST_POSITIVE, TEST_NEGATIVE = ["the", "la", "die"], ["of", "de", "der"]
TEST_PRICING, TEST_RIVALS = ["with", "avec", "mit"], ["from", "pour", "von"]


@check(
    "fea_lexicon_documents",
    f"""WITH {DOCS}, {_scored('docs', TEST_POSITIVE, TEST_NEGATIVE)}
        SELECT conversation_id, round(score, 4) AS sentiment_score, label AS sentiment_label, pressure AS severity,
               {_any('low', TEST_PRICING)} AS pricing_mentioned, {_any('low', TEST_RIVALS)} AS competitor_mentioned
        FROM lab""",
)
def fea_lexicon_documents(spark, sf):
    f = feature_record(
        docs(spark, sf), 0, positive=TEST_POSITIVE, negative=TEST_NEGATIVE, pricing=TEST_PRICING, competitors=TEST_RIVALS
    )
    return f.select(
        "metadata.conversation_id",
        "nlp_features.sentiment_score",
        "nlp_features.sentiment_label",
        "nlp_features.advanced_analysis.complaint_analysis.severity",
        "business_features.pricing_mentioned",
        "business_features.competitor_mentioned",
    )


@check(
    "fea_turns",
    f"""WITH turns AS (SELECT concat(CAST(conv_id AS VARCHAR), '-', CAST(turn AS VARCHAR)) AS conversation_id,
            text AS transcript FROM conversations), {_scored('turns', TEST_POSITIVE, TEST_NEGATIVE)}
        SELECT conversation_id, label AS sentiment_label, CAST(len(words) AS INT) AS word_count FROM lab""",
)
def fea_turns(spark, sf):
    turns = table(spark, sf, "conversations").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("conversation_id"),
        F.col("text").alias("transcript"),
    )
    f = feature_record(turns, 0, positive=TEST_POSITIVE, negative=TEST_NEGATIVE)
    return f.select("metadata.conversation_id", "nlp_features.sentiment_label", "metadata.word_count")


@check(
    "fea_topic_tags",
    f"""WITH {CALLS}, t AS (SELECT conversation_id, {_tags('lower(transcript)', V.TOPIC_TAGS)} AS tags FROM calls)
        SELECT conversation_id, CASE WHEN tags = '' THEN 'general' ELSE tags END AS topics FROM t""",
)
def fea_topic_tags(spark, sf):
    f = feature_record(calls(spark, sf), 0)
    path = "nlp_features.advanced_analysis.call_analysis.primary_topics"
    return f.select("metadata.conversation_id", F.array_join(path, "|").alias("topics"))


@check(
    "fea_pain_tags",
    f"""WITH {CALLS} SELECT conversation_id, {_tags('lower(transcript)', V.PAIN_TAGS)} AS pains FROM calls""",
)
def fea_pain_tags(spark, sf):
    f = feature_record(calls(spark, sf), 0)
    path = "nlp_features.advanced_analysis.complaint_analysis.complaint_keywords"
    return f.select("metadata.conversation_id", F.array_join(path, "|").alias("pains"))


@check(
    "fea_metric_sentiment",
    f"""WITH {CALLS}, {_scored('calls', V.POSITIVE_WORDS, V.NEGATIVE_WORDS)}
        SELECT conversation_id, CASE WHEN contains(low, 'roas') THEN label ELSE 'neutral' END AS roas_sentiment,
               CASE WHEN contains(low, 'cpc') THEN label ELSE 'neutral' END AS cpc_sentiment,
               'neutral' AS targeting_effectiveness, 'neutral' AS rep_sentiment, label AS advertiser_sentiment FROM lab""",
)
def fea_metric_sentiment(spark, sf):
    f = feature_record(calls(spark, sf), 0)
    return f.select(
        "metadata.conversation_id", "nlp_features.advanced_analysis.performance_metrics_sentiment.*"
    )


@check(
    "fea_record",
    f"""WITH {CALLS}, {_scored('calls', V.POSITIVE_WORDS, V.NEGATIVE_WORDS)}
        SELECT label AS sentiment_label, pressure AS urgency, {_any('low', V.PRICING_TERMS)} AS pricing,
               {_any('low', V.COMPETITOR_TERMS)} AS rival, {_tags('low', V.PAIN_TAGS)} AS pains, 'v1.2' AS version,
               CAST(1700000000000 AS BIGINT) AS processed_at, count(*) AS calls,
               CAST(sum(len(words)) AS BIGINT) AS words, CAST(sum(people) AS BIGINT) AS people,
               CAST(sum(duration_seconds) AS BIGINT) AS seconds, CAST(sum(CAST(round(round(score, 4) * 10000) AS BIGINT)) AS BIGINT) AS score_units
        FROM lab GROUP BY ALL""",
)
def fea_record(spark, sf):
    f = feature_record(calls(spark, sf), 1_700_000_000_000)
    a = "nlp_features.advanced_analysis"
    flat = f.select(
        F.col("nlp_features.sentiment_label"),
        F.col(f"{a}.call_analysis.urgency"),
        F.col(f"{a}.complaint_analysis.pricing_complaint").alias("pricing"),
        F.col(f"{a}.complaint_analysis.competitor_mentioned").alias("rival"),
        F.array_join(f"{a}.complaint_analysis.complaint_keywords", "|").alias("pains"),
        F.col("processing_version").alias("version"),
        F.col("processing_timestamp").alias("processed_at"),
        "metadata",
        F.col("nlp_features.sentiment_score").alias("score"),
    )
    return flat.groupBy(
        "sentiment_label", "urgency", "pricing", "rival", "pains", "version", "processed_at"
    ).agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum("metadata.word_count").alias("words"),
        F.sum("metadata.participant_count").alias("people"),
        F.sum("metadata.duration_seconds").alias("seconds"),
        F.sum(F.round(F.col("score") * 10000).cast("bigint")).alias("score_units"),
    )


def _replace_chain(column: str) -> str:
    expr = column
    for entity, char in X.BASIC_ENTITIES.items():
        quoted = char.replace("'", "''")
        expr = f"replace({expr}, '{entity}', '{quoted}')"
    return expr


@check("fea_html_decode", f"SELECT page_id, md5({_replace_chain('html')}) AS decoded FROM pages")
def fea_html_decode(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(X.decode_entities(F.col("html"))).alias("decoded"))


@check(
    "fea_html_decode_native",
    f"SELECT page_id, CAST(length({_replace_chain('html')}) AS INT) AS chars FROM pages",
)
def fea_html_decode_native(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", F.char_length(X.decode_basic_entities(F.col("html"))).alias("chars")
    )


@check(
    "fea_segments",
    r"""WITH parts AS (SELECT doc_id, string_split(text, '. ') AS p FROM documents),
          cut AS (SELECT doc_id, unnest(p) AS s, generate_subscripts(p, 1) - 1 AS pos FROM parts)
        SELECT doc_id, CAST(pos AS INT) AS pos, CASE WHEN pos % 2 = 0 THEN 'rep' ELSE 'customer' END AS speaker,
               md5(concat(regexp_replace(s, '^\s+|\s+$', '', 'g'), '.')) AS text
        FROM cut WHERE regexp_replace(s, '^\s+|\s+$', '', 'g') <> ''""",
)
def fea_segments(spark, sf):
    return docs(spark, sf).select("doc_id", F.inline(X.segments(F.col("transcript")))).select(
        "doc_id", "pos", "speaker", F.md5("text").alias("text")
    )


def _raw_mood():
    words = ["Satisfied", "dissatisfied", "Mixed feelings", "poor", "no idea", "", "Okay", "NEGATIVE", "great", "neutral"]
    return words


_MOOD_SQL = "CASE o_orderkey % 10 " + " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(_raw_mood())) + " END"


def _normalize_sql(order) -> str:
    return "CASE " + " ".join(f"WHEN {_any('low', V.SENTIMENT_TERMS[s])} THEN '{s}'" for s in order) + " END"


@check(
    "fea_sentiment_labels",
    f"""WITH m AS (SELECT o_orderkey, lower({_MOOD_SQL}) AS low FROM orders)
        SELECT o_orderkey, {_normalize_sql(['positive', 'negative', 'neutral'])} AS label,
               {_normalize_sql(['negative', 'positive', 'neutral'])} AS strict_label FROM m""",
)
def fea_sentiment_labels(spark, sf):
    words = F.array(*[F.lit(w) for w in _raw_mood()])
    raw = F.element_at(words, (F.col("o_orderkey") % 10 + 1).cast("int"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        X.normalize_sentiment(raw).alias("label"),
        X.normalize_sentiment(raw, strict=True).alias("strict_label"),
    )


def topic_sql(column: str) -> str:
    """SQL twin of topic consolidation for lower-case topics."""
    groups = " ".join(f"WHEN {_any(column, terms)} THEN '{name}'" for name, terms in V.TOPIC_GROUPS.items())
    title = f"array_to_string(list_transform(string_split(regexp_replace({column}, '[_-]', ' ', 'g'), ' '), lambda w: concat(upper(substr(w, 1, 1)), substr(w, 2))), ' ')"
    return f"CASE {groups} ELSE {title} END"


@check(
    "fea_topic_consolidation",
    f"""WITH {TP}, l AS (SELECT l_orderkey, lower(topic) AS t FROM tp)
        SELECT l_orderkey, {topic_sql('t')} AS topic, count(*) AS n FROM l GROUP BY ALL""",
)
def fea_topic_consolidation(spark, sf):
    """Counts are taken within an order's row, as it has all topics of the order."""
    names = F.transform("topics", lambda t: X.consolidate_topic(t))
    raw = topics(spark, sf).select("l_orderkey", names.alias("names"))
    counts = F.transform(
        F.array_distinct("names"),
        lambda t: F.struct(t.alias("topic"), F.size(F.filter("names", lambda u: u.eqNullSafe(t))).cast("long").alias("n")),
    )
    return raw.select("l_orderkey", F.inline(counts))


@check(
    "fea_urgency_score",
    f"""WITH {INS} SELECT conversation_id, CAST(CASE urgency WHEN 'high' THEN 3 WHEN 'seasonal_pressure' THEN 4
        WHEN 'medium' THEN 2 ELSE 1 END AS INT) AS urgency_score FROM ins""",
)
def fea_urgency_score(spark, sf):
    return ins(spark, sf).select("conversation_id", X.urgency_score(F.col("urgency")).alias("urgency_score"))


_SHORT_HEAD = P.SHORT_HEADER.format(keys=", ".join(P.INSIGHT_FIELDS)).replace("'", "''")
_FULL_HEAD = (P.FULL_HEADER.format(n=10) + P.category_block() + "\n\nConversation:\n").replace("'", "''")


@check("fea_prompt", f"SELECT doc_id, md5(concat('{_SHORT_HEAD}', coalesce(text, ''))) AS prompt FROM documents")
def fea_prompt(spark, sf):
    return docs(spark, sf).select("doc_id", F.md5(P.short_prompt(F.col("transcript"))).alias("prompt"))


@check("fea_full_prompt", f"SELECT doc_id, md5(concat('{_FULL_HEAD}', coalesce(text, ''))) AS prompt FROM documents")
def fea_full_prompt(spark, sf):
    return docs(spark, sf).select("doc_id", F.md5(P.full_prompt(F.col("transcript"))).alias("prompt"))


@check(
    "fea_retry_prompt",
    """SELECT doc_id, md5(concat('Your last answer <previous_response>', source, '</previous_response> was refused because: <invalid_reason>',
        lang, '</invalid_reason>. Answer again and follow the instructions exactly. ', text)) AS prompt FROM documents""",
)
def fea_retry_prompt(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.md5(P.retry_prompt(F.col("text"), F.col("source"), F.col("lang"))).alias("prompt"))


_RULE_SQL = f"""low AS (SELECT conversation_id, lower(transcript) AS low FROM calls),
  mood AS (SELECT *, CASE WHEN {_any('low', V.RULE_POSITIVE)} THEN 'positive'
                          WHEN {_any('low', V.RULE_NEGATIVE)} THEN 'negative' ELSE 'neutral' END AS mood FROM low)"""


@check(
    "fea_rule_insight",
    f"""WITH {CALLS}, {_RULE_SQL} SELECT conversation_id,
        concat(CASE WHEN contains(low, 'roas') THEN 'Performance Metrics' ELSE 'Budget Optimization' END, '|Campaign Structure') AS topics,
        mood AS sentiment, CASE WHEN {_any('low', V.RULE_URGENT)} THEN 'high' ELSE 'medium' END AS urgency,
        contains(low, 'budget') AS scale_issue,
        CASE WHEN contains(low, 'budget') THEN 'limited' ELSE 'good' END AS scale,
        coalesce(CASE WHEN contains(low, 'budget') THEN 'budget_limited' END, '-') AS budget,
        CASE WHEN {_any('low', ['auto', 'suggest'])} THEN 'enable_auto_bidding' ELSE '' END AS bids,
        coalesce(CASE WHEN contains(low, 'roas') THEN 'below_target_roas' END, '-') AS issue,
        CASE WHEN {_any('low', V.RULE_COMPETITORS)} THEN 'Google Ads' ELSE '-' END AS program,
        CASE WHEN contains(low, 'cpc') THEN 'negative' ELSE 'neutral' END AS cpc,
        CASE WHEN contains(low, 'roas') THEN 'negative' ELSE 'neutral' END AS roas,
        CASE WHEN contains(low, 'roas') THEN 'below_target_roas' ELSE '' END AS complaints, mood AS perception
        FROM mood""",
)
def fea_rule_insight(spark, sf):
    i = calls(spark, sf).select("conversation_id", rule_insight(F.col("transcript")).alias("i"))
    return i.select(
        "conversation_id",
        F.array_join("i.callAnalysis.primaryTopics", "|").alias("topics"),
        F.col("i.callAnalysis.overallSentiment").alias("sentiment"),
        F.col("i.callAnalysis.urgencyLevel").alias("urgency"),
        F.col("i.campaignScale.scaleIssuesReported").alias("scale_issue"),
        F.col("i.campaignScale.scalePerception").alias("scale"),
        F.coalesce("i.budgetAndBidding.budgetUtilization", F.lit("-")).alias("budget"),
        F.array_join("i.budgetAndBidding.bidAdjustments", "|").alias("bids"),
        F.coalesce("i.callAnalysis.currentIssue", F.lit("-")).alias("issue"),
        F.coalesce("i.complaintAnalysis.programMentioned", F.lit("-")).alias("program"),
        F.col("i.performanceMetricsSentiment.cpcSentiment").alias("cpc"),
        F.col("i.performanceMetricsSentiment.roasSentiment").alias("roas"),
        F.array_join("i.complaintAnalysis.complaintKeywords", "|").alias("complaints"),
        F.col("i.performanceMetricsSentiment.advertiserPerception").alias("perception"),
    )


@check(
    "fea_derived_fields",
    f"""WITH {CALLS}, {_RULE_SQL} SELECT conversation_id, mood AS sentiment,
        CASE WHEN {_any('low', V.RULE_URGENT)} THEN 'high' ELSE 'medium' END AS urgency,
        contains(low, 'budget') OR contains(low, 'roas') AS pricing_mentioned,
        {_any('low', V.RULE_COMPETITORS)} AS competitor_mentioned FROM mood""",
)
def fea_derived_fields(spark, sf):
    i = calls(spark, sf).select("conversation_id", rule_insight(F.col("transcript")).alias("i"))
    d = derived_fields(F.col("i"))
    return i.select(
        "conversation_id", *[d[k].alias(k) for k in ("sentiment", "urgency", "pricing_mentioned", "competitor_mentioned")]
    )


@check(
    "fea_token_estimate",
    f"SELECT doc_id, CAST(len({_tokens('text')}) AS INT) AS tokens FROM documents",
)
def fea_token_estimate(spark, sf):
    return docs(spark, sf).select("doc_id", X.token_estimate(F.col("transcript")).alias("tokens"))
