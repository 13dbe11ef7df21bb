"""Record layouts: calls, account metadata and the ten-category insight record."""

from __future__ import annotations

from pyspark.sql import types as T

# The allowed labels of each closed vocabulary (case-sensitive).
ENUMS = {
    "sentiment": ["positive", "negative", "neutral", "mixed"],
    "urgency": ["low", "medium", "high", "seasonal_pressure"],
    "experience": ["beginner", "intermediate", "experienced", "expert"],
    "scale": ["good", "limited", "very_limited"],
    "campaign": ["Sponsored_Products", "Sponsored_Brands", "Sponsored_Display"],
    "budget": ["budget_limited", "under_spending", "optimal"],
    "bidding": ["aggressive", "conservative", "competitive"],
    "severity": ["low", "medium", "high"],
}

# Category -> field -> kind. Kinds: text, texts, number, flag, enum name, or a
# nested field table. Every field may be absent except callAnalysis.primaryTopics.
INSIGHT_FIELDS = {
    "identificationMetrics": {
        "repName": "text",
        "asinMentioned": "texts",
        "campaignNames": "texts",
        "tenureInformation": "text",
    },
    "campaignStructure": {"primaryCampaignType": "campaign", "targetingTypes": "texts"},
    "campaignScale": {
        "scaleIssuesReported": "flag",
        "limitedTargetingMentioned": "flag",
        "scalePerception": "scale",
        "targetingRestrictions": "texts",
        "recommendedScaleImprovements": "texts",
    },
    "budgetAndBidding": {
        "dailyBudget": "number",
        "monthlyBudget": "number",
        "budgetUtilization": "budget",
        "biddingStrategy": "bidding",
        "seasonalStrategy": "text",
        "bidAdjustments": "texts",
    },
    "callAnalysis": {
        "primaryTopics": "texts",
        "primaryTopicSentiment": "sentiment",
        "secondaryTopics": "texts",
        "resolutionType": "text",
        "overallSentiment": "sentiment",
        "customerExperience": "experience",
        "urgencyLevel": "urgency",
        "currentIssue": "text",
        "pastIssue": "text",
        "pastIssueStatus": "text",
        "resolutionSummary": "text",
    },
    "seasonalContext": {"seasonalPressure": "flag", "peakSeasonTiming": "text", "seasonalEvents": "texts"},
    "actionItems": {
        "immediateActions": "texts",
        "bidOptimizations": "texts",
        "nextSteps": "texts",
        "scaleImprovementActions": "texts",
    },
    "complaintAnalysis": {
        "complaintKeywords": "texts",
        "complaintPhrases": "texts",
        "programMentioned": "text",
        "complaintSeverity": "severity",
        "scaleRelatedComplaints": "texts",
        "programSpecificComplaints": {"SD": "texts", "SP": "texts", "SB": "texts"},
    },
    "featureAdaptability": {
        "knownFeatures": "texts",
        "discussedFeatures": "texts",
        "learnedFeatures": "texts",
        "featureAdaptability": "text",
        "featuresAdvertisersKnows": "texts",
        "featuresAdvertiserTalksAbout": "texts",
        "featuresAdvertiserLearnt": "texts",
    },
    "performanceMetricsSentiment": {
        "roasSentiment": "sentiment",
        "cpcSentiment": "sentiment",
        "cpmSentiment": "sentiment",
        "vcpmSentiment": "sentiment",
        "targetingClausesSentiment": "sentiment",
        "biddingStrategiesSentiment": "sentiment",
        "roasSentimentAdvertiser": "sentiment",
        "cpcSentimentAdvertiser": "sentiment",
        "vcpmSentimentAdvertiser": "sentiment",
        "targetingClausesSentimentAdvertiser": "sentiment",
        "advertiserPerception": "sentiment",
    },
}
CATEGORIES = list(INSIGHT_FIELDS)

_SPARK_TYPES = {
    "texts": T.ArrayType(T.StringType()),
    "number": T.DoubleType(),
    "flag": T.BooleanType(),
}


def struct_of(fields: dict) -> T.StructType:
    """Spark struct type of a field table."""
    return T.StructType(
        [
            T.StructField(
                name,
                struct_of(kind) if isinstance(kind, dict) else _SPARK_TYPES.get(kind, T.StringType()),
            )
            for name, kind in fields.items()
        ]
    )


INSIGHT_TYPE = struct_of(INSIGHT_FIELDS)

CALL_TYPE = T.StructType(
    [
        T.StructField("conversation_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("call_date", T.StringType()),
        T.StructField("duration_seconds", T.IntegerType()),
        T.StructField("campaign_type", T.StringType()),
        T.StructField("team", T.StringType()),
        T.StructField("advertiser_id", T.StringType()),
        T.StructField("marketplace_id", T.StringType()),
        T.StructField(
            "participants",
            T.ArrayType(
                T.StructType(
                    [T.StructField("role", T.StringType()), T.StructField("talk_time", T.IntegerType())]
                )
            ),
        ),
        T.StructField("transcript", T.StringType()),
        T.StructField(
            "transcript_segments",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("speaker", T.StringType()),
                        T.StructField("text", T.StringType()),
                        T.StructField("timestamp", T.StringType()),
                        T.StructField("confidence", T.DoubleType()),
                    ]
                )
            ),
        ),
        T.StructField("processed_insights", INSIGHT_TYPE),
        T.StructField("schema_valid", T.BooleanType()),
        T.StructField("processing_version", T.StringType()),
    ]
)

METADATA_TYPE = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "conversation_id",
            "advertiser_id",
            "account_name",
            "opportunity_stage",
            "marketplace_id",
            "advertiser_tier",
            "account_record_id",
            "industry_vertical",
        )
    ]
)
