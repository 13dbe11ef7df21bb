"""Whether a scorer's answer fits the insight layout, one answer at a time.

The scoring job asks this between two tries, inside the task that talks to the scorer; the typed insight comes
from ``responses.check_responses``, whose rules these are.
"""

from __future__ import annotations

import json

from parley.functions import vocabulary as V
from parley.functions.responses import FALSE_WORDS, TRUE_WORDS
from parley.schemas import ENUMS, INSIGHT_FIELDS

NO_OBJECT = "answer holds no JSON object"
_ABSENT = object()


def _unique(pairs: list[tuple[str, object]]) -> dict:
    if len(dict(pairs)) < len(pairs):
        raise ValueError("a key occurs twice")
    return dict(pairs)


def _no_constant(name: str) -> None:
    raise ValueError(f"{name} is not JSON")


def _object(raw: str | None) -> dict | None:
    raw = raw or ""
    first, last = raw.find("{"), raw.rfind("}")
    try:
        found = json.loads(raw[first : last + 1], object_pairs_hook=_unique, parse_constant=_no_constant)
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def _is_number(value: object) -> bool:
    if isinstance(value, str):
        try:
            float(value)
        except ValueError:
            return False
        return "_" not in value
    return isinstance(value, (bool, int, float))


def _texts(value: object) -> bool:
    return isinstance(value, list) and all(isinstance(x, str) for x in value)


def _fits(kind: str, value: object) -> bool:
    if value is _ABSENT:
        return True
    if kind == "texts":
        return _texts(value)
    if kind == "flag":
        if isinstance(value, str):
            return value.lower() in TRUE_WORDS + FALSE_WORDS
        return isinstance(value, (bool, int, float)) and value in (0, 1)
    if value is None:
        return True
    if kind == "number":
        return _is_number(value)
    return isinstance(value, str) and (kind not in ENUMS or value in ENUMS[kind])


def _topics(value: object) -> bool:
    empty = value is None or value in ([], {}) or (not isinstance(value, str) and _is_number(value) and value == 0)
    return isinstance(value, str) or empty or _texts(value)


def problem(raw: str | None) -> str | None:
    """Why an answer is refused; None if it is accepted."""
    found = _object(raw)
    if found is None:
        return NO_OBJECT
    flat = "callAnalysis" not in found
    for category, fields in INSIGHT_FIELDS.items():
        given = found.get(category, {})
        if not isinstance(given, dict):
            return V.INVALID_REASON
        for field, kind in fields.items():
            value = given.get(field, _ABSENT)
            if (category, field) == ("callAnalysis", "primaryTopics"):
                if flat:
                    value = found.get("key_topics", found.get("primary_topics", _ABSENT))
                good = flat if value is _ABSENT else _topics(value)
            elif isinstance(kind, dict):
                inner = {} if value is _ABSENT else value
                good = isinstance(inner, dict) and all(_fits(k, inner.get(f, _ABSENT)) for f, k in kind.items())
            else:
                if flat and category == "callAnalysis":
                    value = found.get({"overallSentiment": "sentiment", "urgencyLevel": "urgency"}.get(field), _ABSENT)
                good = _fits(kind, value)
            if not good:
                return V.INVALID_REASON
    return None
