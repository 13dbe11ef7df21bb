"""Column expressions over call text. All are native; only ``decode_entities`` may enter Python."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.functions import vocabulary as V

# Whitespace as a text editor sees it, Unicode spaces and the separator controls.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
EDGES = rf"^[{SPACES}]+|[{SPACES}]+$"


def tokens(text: Column) -> Column:
    """Whitespace-separated tokens, punctuation kept.

    All spaces become blanks first: a split on one plain character needs no regular expression.
    """
    plain = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(plain, " "), "")


def word_count(text: Column) -> Column:
    return F.size(tokens(text))


def _quoted(term: str) -> str:
    return "\\Q" + term + "\\E"


def mentions(lower_text: Column, terms: Sequence[str], word_boundary: bool = False) -> Column:
    """True if any term occurs; as a substring, or as a whole word with ``word_boundary``."""
    if word_boundary:
        hit = lower_text.rlike(r"\b(?:" + "|".join(_quoted(t) for t in terms) + r")\b")
    else:
        hit = F.lit(False)
        for term in terms:
            hit = hit | lower_text.contains(term)
    return F.coalesce(hit, F.lit(False))


def hits(words: Column, lexicon: Sequence[str]) -> Column:
    """Number of tokens that are in the lexicon."""
    return F.size(F.filter(words, lambda w: w.isin(*lexicon)))


def tags(lower_text: Column, tag_map: Mapping[str, str], default: str | None = None) -> Column:
    """Labels of all substrings that occur, in map order; ``[default]`` when there are none."""
    found = F.array_compact(
        F.array(*[F.when(lower_text.contains(term), F.lit(label)) for term, label in tag_map.items()])
    )
    if default is None:
        return found
    return F.when(F.size(found) == 0, F.array(F.lit(default))).otherwise(found)


def lexicon_score(positives: Column, negatives: Column) -> Column:
    """Unrounded score in [-1, 1]; 0 when there is no hit."""
    return (positives - negatives) / F.greatest(positives + negatives, F.lit(1))


def score_label(score: Column, cut: float = V.LABEL_CUT) -> Column:
    return F.when(score > cut, "positive").when(score < -cut, "negative").otherwise("neutral")


def pressure_bucket(negatives: Column) -> Column:
    """Urgency and severity share one scale over the number of negative words."""
    return F.when(negatives > 3, "high").when(negatives > 1, "medium").otherwise("low")


def conditional_label(lower_text: Column, term: str, label: Column) -> Column:
    return F.when(lower_text.contains(term), label).otherwise("neutral")


def urgency_score(level: Column, scores: Mapping[str, int] = V.URGENCY_SCORES) -> Column:
    expr = F.lit(1)
    for name, score in reversed(list(scores.items())):
        expr = F.when(level == name, score).otherwise(expr)
    return expr


def normalize_sentiment(raw: Column, strict: bool = False) -> Column:
    """Map any sentiment wording to three labels, else NULL.

    Positive terms are tested first, so ``dissatisfied`` counts as positive through ``satisfied``.
    ``strict`` tests the negative terms first.
    """
    text = F.lower(raw)
    order = ["negative", "positive", "neutral"] if strict else ["positive", "negative", "neutral"]
    expr = F.lit(None).cast("string")
    for label in reversed(order):
        expr = F.when(mentions(text, V.SENTIMENT_TERMS[label]), label).otherwise(expr)
    return expr


def consolidate_topic(
    topic: Column,
    groups: Mapping[str, Sequence[str]] = V.TOPIC_GROUPS,
    max_chars: int | None = None,
) -> Column:
    """Name of the first topic group with a hit, else a title-cased form of the topic itself.

    ``initcap`` differs from other title-casing rules after digits and apostrophes.
    """
    text = F.lower(F.trim(topic))
    expr = F.initcap(F.regexp_replace(F.trim(topic), "[_-]", " "))
    if max_chars is not None:
        expr = F.substring(expr, 1, max_chars)
    for name, terms in reversed(list(groups.items())):
        expr = F.when(mentions(text, terms), name).otherwise(expr)
    return expr


def is_real_topic(topic: Column, blanks: Sequence[str] = V.BLANK_TOPICS) -> Column:
    return topic.isNotNull() & ~F.trim(topic).isin(*blanks)


# The entities that ordinary prose needs. ``&amp;`` comes last, or ``&amp;lt;`` would
# be decoded twice.
BASIC_ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&copy;": "©",
    "&middot;": "·",
    "&amp;": "&",
}


def decode_basic_entities(text: Column, table: Mapping[str, str] = BASIC_ENTITIES) -> Column:
    """JVM-only decoding, exact when the text holds no other entity than those in the table."""
    expr = text
    for entity, char in table.items():
        expr = F.replace(expr, F.lit(entity), F.lit(char))
    return expr


def decode_entities(text: Column) -> Column:
    """Decode all HTML5 character references in one pass.

    Only texts with an ampersand that the basic table cannot explain are handed to Python; the
    others are decoded in the JVM and cross the Arrow boundary as NULL.
    """
    @F.pandas_udf("string")
    def unescape(batch: pd.Series) -> pd.Series:
        from html import unescape as decode

        return batch.map(decode, na_action="ignore")

    known = "|".join(_quoted(e) for e in BASIC_ENTITIES)
    # An ampersand that starts no known entity, or a decoded ampersand that would start a new one.
    hard = text.rlike(f"&(?!(?:{'|'.join(_quoted(e[1:]) for e in BASIC_ENTITIES)}))") | text.rlike(
        f"(?:{known})(?<=&amp;)[a-zA-Z#]"
    )
    return F.coalesce(unescape(F.when(hard, text)), decode_basic_entities(text))


def segments(text: Column, speakers: Sequence[str] = ("rep", "customer")) -> Column:
    """Sentences as ``array<struct<pos, speaker, text>>``; speakers alternate by position.

    Blank sentences are dropped after the positions are given, so they still switch the speaker.
    """
    names = F.array(*[F.lit(s) for s in speakers])
    parts = F.transform(
        F.split(text, r"\. "),
        lambda s, i: F.struct(
            i.alias("pos"),
            F.element_at(names, i % len(speakers) + 1).alias("speaker"),
            F.regexp_replace(s, EDGES, "").alias("text"),
        ),
    )
    kept = F.filter(parts, lambda p: p["text"] != "")
    return F.transform(
        kept,
        lambda p: F.struct(
            p["pos"].alias("pos"),
            p["speaker"].alias("speaker"),
            F.concat(p["text"], F.lit(".")).alias("text"),
        ),
    )


def token_estimate(text: Column, max_tokens: int | None = None) -> Column:
    return word_count(text) if max_tokens is None else F.least(word_count(text), F.lit(max_tokens))
