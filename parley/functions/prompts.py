"""Prompt text for an external scorer. The instruction block is built once from the field table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.functions import vocabulary as V
from parley.schemas import ENUMS, INSIGHT_FIELDS

SHORT_HEADER = (
    "Read the advertiser call below and answer with one JSON object only. "
    "Its top-level keys are: {keys}.\n\nConversation:\n"
)
FULL_HEADER = (
    "Read the advertiser call below and fill in all {n} categories. "
    "Answer with one JSON object that has every category as a top-level key.\n\n"
)
# One line of guidance per category, in our own words.
GUIDANCE = {
    "identificationMetrics": "Who speaks for us, which items and campaigns are named, how long the customer has been with us.",
    "campaignStructure": "The main campaign type and the kinds of targeting that are discussed.",
    "campaignScale": "Reach and volume: reported limits, restrictions, proposed improvements.",
    "budgetAndBidding": "Budgets that are stated as amounts, how well they are used, the bidding approach.",
    "callAnalysis": "Topics, mood, urgency, experience of the customer, open and past issues, outcome.",
    "seasonalContext": "Seasonal pressure, peak periods and events, only where confirmed.",
    "actionItems": "What was agreed: immediate steps, bid changes, follow-ups, scale measures.",
    "complaintAnalysis": "Complaints: words, phrases, named programs, severity, per campaign type.",
    "featureAdaptability": "Features the customer knows, talks about or learns.",
    "performanceMetricsSentiment": "Mood about each performance metric, from both sides.",
}


def _describe(kind) -> str:
    if isinstance(kind, dict):
        return "{" + ", ".join(f'"{k}": {_describe(v)}' for k, v in kind.items()) + "}"
    if kind in ENUMS:
        return '"' + "|".join(ENUMS[kind]) + '|null"'
    return {"texts": '["string"]', "number": '"number|null"', "flag": '"boolean"'}.get(kind, '"string|null"')


def category_block() -> str:
    return "\n\n".join(
        f"--- {name} ---\n{GUIDANCE[name]}\nOutput schema: {{\"{name}\": {_describe(fields)}}}"
        for name, fields in INSIGHT_FIELDS.items()
    )


def _shown(text: Column, max_chars: int | None) -> Column:
    """The whole text, unless a length is asked for."""
    whole = F.coalesce(text, F.lit(""))
    return whole if max_chars is None else F.substring(whole, 1, max_chars)


def short_prompt(text: Column, template: str | None = None, max_chars: int | None = None) -> Column:
    head = template or SHORT_HEADER.format(keys=", ".join(INSIGHT_FIELDS))
    return F.concat(F.lit(head), _shown(text, max_chars))


def full_prompt(text: Column, max_chars: int | None = None) -> Column:
    head = FULL_HEADER.format(n=len(INSIGHT_FIELDS)) + category_block() + "\n\nConversation:\n"
    return F.concat(F.lit(head), _shown(text, max_chars))


#: What is put before the prompt after a refused answer: the answer and the reason.
RETRY_HEADER = (
    "Your last answer <previous_response>{answer}</previous_response> was refused because: "
    "<invalid_reason>{reason}</invalid_reason>. Answer again and follow the instructions exactly. "
)


def retry_prompt(prompt: Column, previous: Column, reason: Column) -> Column:
    """The earlier answer and why it was refused, then the prompt again."""
    head, rest = RETRY_HEADER.split("{answer}")
    middle, tail = rest.split("{reason}")
    return F.concat(F.lit(head), previous, F.lit(middle), reason, F.lit(tail), prompt)


def retry_text(prompt: str, previous: str, reason: str) -> str:
    """The same for one prompt in a task."""
    head, rest = RETRY_HEADER.split("{answer}")
    middle, tail = rest.split("{reason}")
    return f"{head}{previous}{middle}{reason}{tail}{prompt}"
