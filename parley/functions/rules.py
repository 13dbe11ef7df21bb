"""Rule-based insight, derived insight fields and the suggestion rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions import vocabulary as V
from parley.functions.text import mentions
from parley.schemas import INSIGHT_TYPE


def _typed_struct(spec: dict, fields: T.StructType) -> Column:
    """Struct with every field of the type; fields without an entry are empty, false or NULL."""
    cols = []
    for field in fields:
        value = spec.get(field.name)
        if isinstance(field.dataType, T.StructType):
            value = _typed_struct(value or {}, field.dataType)
        elif isinstance(field.dataType, T.ArrayType):
            value = F.array() if value is None else value
            value = value.cast(field.dataType)
        elif isinstance(field.dataType, T.BooleanType):
            value = F.lit(False) if value is None else value
        else:
            value = F.lit(None) if value is None else value
            value = value.cast(field.dataType)
        cols.append(value.alias(field.name))
    return F.struct(*cols)


def _decided(low: Column, dtype: T.DataType, cases: list[tuple[list[str], object]], otherwise: object) -> Column:
    """Value of the first case with a term in the text; a list field takes a single value as its one entry."""

    def value(v: object) -> Column:
        if isinstance(dtype, T.ArrayType):
            entries = v if isinstance(v, list) else [] if v is None else [v]
            return F.array(*[F.lit(x) for x in entries]).cast(dtype)
        return F.lit(v).cast(dtype)

    out = value(otherwise)
    for terms, found in reversed(cases):
        out = F.when(mentions(low, terms), value(found)).otherwise(out)
    return out


def rule_insight(text: Column, rules: Mapping[str, tuple] = V.INSIGHT_RULES) -> Column:
    """Ten-category insight of a transcript by keyword rules.

    ``rules``: ``category.field`` -> (ordered cases of terms and value, value without any). Every other field
    keeps its default; with ``KEYWORD_RULES`` these are all that no keyword decides. The rules see the transcript
    alone, never a prompt around it.
    """
    low = F.lower(F.coalesce(text, F.lit("")))
    spec: dict[str, dict[str, Column]] = {}
    for path, (cases, otherwise) in rules.items():
        category, field = path.split(".")
        spec.setdefault(category, {})[field] = _decided(low, INSIGHT_TYPE[category].dataType[field].dataType, cases, otherwise)
    return _typed_struct(spec, INSIGHT_TYPE)


def empty_insight_with(spec: dict) -> Column:
    """Insight struct with the given category fields and defaults elsewhere."""
    return _typed_struct(spec, INSIGHT_TYPE)


def derived_fields(insight: Column) -> dict[str, Column]:
    """The short names under which reports know parts of an insight."""
    call, complaint = insight["callAnalysis"], insight["complaintAnalysis"]
    return {
        "key_topics": call["primaryTopics"],
        "sentiment": call["overallSentiment"],
        "urgency": call["urgencyLevel"],
        "pricing_mentioned": insight["budgetAndBidding"]["budgetUtilization"].isNotNull()
        | (F.size(complaint["complaintKeywords"]) > 0),
        "competitor_mentioned": complaint["programMentioned"].isNotNull(),
    }


def differs_from_default(category: str, value: Column, fields: T.StructType | None = None) -> Column:
    """True if a category holds anything beyond its defaults."""
    fields = fields or INSIGHT_TYPE[category].dataType
    tests = []
    for field in fields:
        col = value[field.name]
        if isinstance(field.dataType, T.StructType):
            tests.append(differs_from_default(category, col, field.dataType))
        elif isinstance(field.dataType, T.ArrayType):
            tests.append(F.coalesce(F.size(col) > 0, F.lit(False)))
        elif isinstance(field.dataType, T.BooleanType):
            tests.append(F.coalesce(col, F.lit(False)))
        elif field.name == "overallSentiment":
            tests.append(F.coalesce(col != "neutral", F.lit(False)))
        else:
            tests.append(col.isNotNull())
    return reduce(lambda a, b: a | b, tests)


def advice_flags(concern: Column) -> list[Column]:
    """Whether one concern calls for each advice, in the order of ``SUGGESTIONS``. An entity's flags are those of any."""
    low = F.lower(concern)
    return [F.coalesce(mentions(low, terms), F.lit(False)) for terms, _ in V.SUGGESTIONS]


def suggestions(avg_score: Column, flags: Sequence[Column], calls: Column) -> Column:
    """Advice for one entity from the flags of its concerns, its mean score and number of calls."""
    rules = [(flag, advice) for flag, (_, advice) in zip(flags, V.SUGGESTIONS, strict=True)]
    rules.append((avg_score < -V.LABEL_CUT, V.SUGGEST_OUTREACH))
    rules.append((calls >= V.TREND_MIN_CALLS, V.SUGGEST_TREND))
    found = F.array_compact(F.array(*[F.when(cond, F.lit(advice)) for cond, advice in rules]))
    return F.when(F.size(found) == 0, F.array(F.lit(V.SUGGEST_NONE))).otherwise(found)
