"""Word lists, label maps and thresholds. All are defaults that callers may replace."""

COMPETITOR_TERMS = ["google ads", "meta", "microsoft advertising", "trade desk"]
PRICING_TERMS = ["price", "cost", "cpc", "roas", "cpm", "budget"]
REQUEST_TERMS = ["wish", "suggest", "recommend", "would love"]

POSITIVE_WORDS = ["great", "excellent", "happy", "improved", "success", "thank"]
NEGATIVE_WORDS = ["issue", "problem", "fail", "struggle", "down", "broken", "frustrated"]

# Substring -> tag, in the order in which tags are listed.
TOPIC_TAGS = {
    "roas": "roas_optimization",
    "bidding": "bidding_strategy",
    "targeting": "audience_targeting",
    "budget": "budget_management",
    "reporting": "reporting_analytics",
    "campaign": "campaign_structure",
}
PAIN_TAGS = {
    "budget": "budget_exhaustion",
    "conversion": "low_conversion_rate",
    "impression": "low_impressions",
    "cpc": "high_cpc",
    "roas": "below_target_roas",
}

# Label -> substrings; the first label with a hit wins.
SENTIMENT_TERMS = {
    "positive": ["positive", "satisfied", "good", "excellent", "great"],
    "negative": ["negative", "dissatisfied", "bad", "poor", "frustrated"],
    "neutral": ["neutral", "mixed", "moderate", "okay", "average"],
}
TOPIC_GROUPS = {
    "Sponsored Display": ["sd", "display", "sponsoreddisplay"],
    "Sponsored Products": ["sp", "products", "sponsoredproducts"],
    "Sponsored Brands": ["sb", "brands", "sponsoredbrands"],
    "Budget Optimization": ["budget", "budgeting", "spend", "budget_management"],
    "Targeting Issues": ["targeting", "audience", "keywords", "targeting_strategy"],
    "Performance Metrics": ["performance", "roas", "cpc", "metrics", "roas_optimization"],
    "Bidding Strategy": ["bidding", "bids", "bid", "bidding_strategy", "bidding_optimization"],
    "Campaign Structure": ["campaign", "structure", "campaign_structure"],
    "Reporting": ["reporting", "analytics", "reporting_analytics"],
    "Action Items": ["action", "recommendation", "optimization_rec"],
}
BLANK_TOPICS = ["", "Unknown", "null"]

SENTIMENT_LABELS = ["positive", "neutral", "negative"]
URGENCY_SCORES = {"high": 3, "seasonal_pressure": 4, "medium": 2}
URGENT_LEVELS = ["high", "seasonal_pressure"]

# Rule-based insight: word lists tested as substrings of the transcript.
RULE_POSITIVE = ["great", "excellent", "success", "happy"]
RULE_NEGATIVE = ["issue", "problem", "frustrated", "fail"]
RULE_URGENT = ["issue", "problem", "fail"]
RULE_COMPETITORS = ["google", "meta", "microsoft"]
# Field -> (terms -> value in the order of testing, value without any of them).
KEYWORD_RULES = {
    "callAnalysis.overallSentiment": ([(RULE_POSITIVE, "positive"), (RULE_NEGATIVE, "negative")], "neutral"),
    "callAnalysis.urgencyLevel": ([(RULE_URGENT, "high")], "medium"),
    "callAnalysis.primaryTopics": ([(["roas"], "Performance Metrics")], "Budget Optimization"),
    "callAnalysis.currentIssue": ([(["roas"], "below_target_roas")], None),
    "campaignScale.scaleIssuesReported": ([(["budget"], True)], False),
    "campaignScale.scalePerception": ([(["budget"], "limited")], "good"),
    "budgetAndBidding.budgetUtilization": ([(["budget"], "budget_limited")], None),
    "budgetAndBidding.bidAdjustments": ([(["auto", "suggest"], "enable_auto_bidding")], None),
    "complaintAnalysis.complaintKeywords": ([(["roas"], "below_target_roas")], None),
    "complaintAnalysis.programMentioned": ([(RULE_COMPETITORS, "Google Ads")], None),
    "performanceMetricsSentiment.roasSentiment": ([(["roas"], "negative")], "neutral"),
    "performanceMetricsSentiment.cpcSentiment": ([(["cpc"], "negative")], "neutral"),
}

# The whole insight: besides, the labels that follow another field, a topic of every call, and the standing answers
# (no terms) of the fields that no keyword decides.
INSIGHT_RULES = {
    **KEYWORD_RULES,
    "identificationMetrics.repName": ([], "Rep"),
    "identificationMetrics.campaignNames": ([], ["Main Campaign"]),
    "campaignStructure.primaryCampaignType": ([], "Sponsored_Products"),
    "campaignStructure.targetingTypes": ([], ["Keyword", "Product"]),
    "callAnalysis.primaryTopics": (
        [(["roas"], ["Performance Metrics", "Campaign Structure"])],
        ["Budget Optimization", "Campaign Structure"],
    ),
    "callAnalysis.primaryTopicSentiment": KEYWORD_RULES["callAnalysis.overallSentiment"],
    "callAnalysis.secondaryTopics": ([], ["Targeting Issues"]),
    "callAnalysis.resolutionType": ([], "partial"),
    "callAnalysis.customerExperience": ([], "intermediate"),
    "callAnalysis.resolutionSummary": ([], "Discussed optimization strategies"),
    "actionItems.immediateActions": ([], ["review_bids", "check_targeting"]),
    "actionItems.bidOptimizations": ([], ["enable_auto_bidding"]),
    "actionItems.nextSteps": ([], ["follow_up_in_1_week"]),
    "complaintAnalysis.complaintSeverity": ([], "medium"),
    "featureAdaptability.knownFeatures": ([], ["auto_bidding"]),
    "featureAdaptability.discussedFeatures": ([], ["target_roas"]),
    "featureAdaptability.featureAdaptability": ([], "intermediate"),
    "performanceMetricsSentiment.targetingClausesSentiment": ([], "neutral"),
    "performanceMetricsSentiment.biddingStrategiesSentiment": ([], "neutral"),
    "performanceMetricsSentiment.roasSentimentAdvertiser": KEYWORD_RULES["performanceMetricsSentiment.roasSentiment"],
    "performanceMetricsSentiment.cpcSentimentAdvertiser": KEYWORD_RULES["performanceMetricsSentiment.cpcSentiment"],
    "performanceMetricsSentiment.targetingClausesSentimentAdvertiser": ([], "neutral"),
    "performanceMetricsSentiment.advertiserPerception": KEYWORD_RULES["callAnalysis.overallSentiment"],
}

# Suggestions, in listing order: terms sought in the joined concerns -> advice.
SUGGESTIONS = [
    (["budget", "budget_management"], "Enable dynamic budget allocation to prevent early exhaustion"),
    (["roas", "roas_optimization"], "Switch to target ROAS bidding strategy to optimize returns"),
    (["targeting"], "Expand audience targeting with lookalike segments to increase reach"),
    (["cpc"], "Implement bid modifiers by device and time-of-day to reduce CPC"),
]
SUGGEST_OUTREACH = "Schedule proactive outreach call — negative sentiment detected"
SUGGEST_TREND = "Review 30-day campaign trend with advertiser to identify pattern"
SUGGEST_NONE = "Campaign performing within normal parameters — continue monitoring"
TREND_MIN_CALLS = 3

LABEL_CUT = 0.1
MAX_OUTPUT_TOKENS = 150
MAX_ATTEMPTS = 4
INVALID_REASON = "response did not conform to required JSON schema"
EXHAUSTED_REASON = "Exhausted retries without valid schema response"
PROCESSING_VERSION = "v1.2"

# Monitoring thresholds.
STALE_HOURS = 25
LATENCY_SLA_MS = 2000
QUALITY_SLA = 0.999
NEGATIVE_RATE_LIMIT = 0.20
ROLLING_DAYS = 3
BREACH_DAYS = 2
COOLDOWN_HOURS = 24
ROLLING_CALLS = 1000
TOKEN_WINDOW_SECONDS = 60
TOKENS_PER_WINDOW = 10_000
REQUESTS_PER_MINUTE = 60
FAILURE_WINDOW_SECONDS = 60
FAILURE_LIMIT = 10
INCIDENT_GAP_SECONDS = 30
FALLBACK_RESPONSE = (
    '{"key_topics":[],"customer_pain_points":[],"suggested_actions":[],"sentiment":"neutral",'
    '"urgency":"low","pricing_mentioned":false,"competitor_mentioned":false}'
)
