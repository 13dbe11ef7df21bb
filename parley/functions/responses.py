"""Parsing and checking of scorer answers (JSON text) against the insight layout.

Every check is a column expression over VARIANT, generated from ``INSIGHT_FIELDS``. ``from_json`` is
not used: it accepts lists of numbers as lists of strings and loses numbers given as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions import vocabulary as V
from parley.functions.text import EDGES
from parley.schemas import CATEGORIES, ENUMS, INSIGHT_FIELDS

# Spellings of true and false that are accepted where a flag is expected.
TRUE_WORDS = ["true", "t", "yes", "y", "on", "1"]
FALSE_WORDS = ["false", "f", "no", "n", "off", "0"]

def _strip(text: Column) -> Column:
    return F.regexp_replace(text, EDGES, "")


def clean_response(raw: Column) -> Column:
    """Answer without outer blanks and without a Markdown code fence around it."""
    text = _strip(F.coalesce(raw, F.lit("")))
    bare = _strip(F.regexp_replace(F.regexp_replace(text, "^```(?:json)?\n?", ""), "`+$", ""))
    return F.when(text.startswith("```"), bare).otherwise(text)


def candidates(raw: Column) -> Column:
    """Texts that may be the JSON object: the whole answer, then its first to last brace."""
    text = clean_response(raw)
    braces = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.when(braces == "", F.array(text)).otherwise(F.array(text, braces))


def answer_object(raw: Column) -> Column:
    """The JSON object of an answer as VARIANT, NULL if there is none.

    Only an object can be valid, and an answer that is an object as a whole runs from its first
    brace to its last, so the second candidate covers the first. Blanks and fences lie outside.
    """
    return F.try_parse_json(F.regexp_extract(raw, r"(?s)\{.*\}", 0))


def _get(v: str, as_type: str) -> str:
    return f"try_variant_get({v}, '$', '{as_type}')"


def _open(v: str, names) -> str:
    """Struct of the named fields as VARIANT; NULL if ``v`` is not an object."""
    return _get(v, "struct<" + ", ".join(f"{n}: variant" for n in names) + ">")


def _words(values: list[str]) -> str:
    return "(" + ", ".join(f"'{x}'" for x in values) + ")"


def _checked(ok: str, value: str) -> str:
    return f"named_struct('ok', coalesce({ok}, false), 'value', {value})"


def _is_text(v: str) -> str:
    return f"schema_of_variant({v}) = 'STRING'"


def _all_texts(v: str) -> str:
    return f"forall({_get(v, 'array<variant>')}, x -> {_is_text('x')})"


def _leaf(kind: str, v: str) -> str:
    """``struct<ok, value>`` of one field, as SQL text."""
    absent = f"{v} IS NULL OR is_variant_null({v})"
    if kind == "texts":
        empty = "CAST(array() AS array<string>)"
        return _checked(f"{v} IS NULL OR {_all_texts(v)}", f"coalesce({_get(v, 'array<string>')}, {empty})")
    if kind == "number":
        return _checked(f"{absent} OR {_get(v, 'double')} IS NOT NULL", _get(v, "double"))
    if kind == "flag":
        word = f"lower({_get(v, 'string')})"
        number = _get(v, "double")
        truth = (
            f"CASE WHEN {v} IS NULL THEN false WHEN {word} IN {_words(TRUE_WORDS)} THEN true "
            f"WHEN {word} IN {_words(FALSE_WORDS)} THEN false WHEN {_is_text(v)} THEN NULL "
            f"WHEN {number} = 1 THEN true WHEN {number} = 0 THEN false END"
        )
        return _checked(f"({truth}) IS NOT NULL", f"coalesce({truth}, false)")
    allowed = f" AND {_get(v, 'string')} IN {_words(ENUMS[kind])}" if kind in ENUMS else ""
    return _checked(f"{absent} OR ({_is_text(v)}{allowed})", _get(v, "string"))


def _topic_leaf(v: str) -> str:
    """Topics: a text becomes a one-item list; JSON null, false, 0, [] and {} become [general]."""
    items, number = _get(v, "array<string>"), _get(v, "double")
    empty = (
        f"is_variant_null({v}) OR coalesce(size({items}) = 0, false) OR schema_of_variant({v}) = 'OBJECT<>' "
        f"OR (NOT {_is_text(v)} AND coalesce({number} = 0, false))"
    )
    value = (
        f"CASE WHEN {_is_text(v)} THEN array({_get(v, 'string')}) WHEN {empty} THEN array('general') ELSE {items} END"
    )
    return _checked(f"{_is_text(v)} OR {empty} OR coalesce({_all_texts(v)}, false)", value)


def check_responses(df: DataFrame, raw: str, prefix: str = "") -> DataFrame:
    """Add ``valid``, ``coerced``, ``reason`` and the typed ``insight`` of each answer.

    An answer without ``callAnalysis`` is read as the flat layout (``key_topics`` or
    ``primary_topics``, ``sentiment``, ``urgency``) and marked ``coerced``. ``insight`` is NULL when
    the answer is not valid. The work is split into projections (object, categories, fields) so that
    each VARIANT is opened once per row. The expressions are SQL text: building some thousand Column
    objects would take longer than the job on a small batch.
    """

    def name(*parts: str) -> str:
        return "__" + prefix + "_".join(parts)

    top, flat, ok = name("top"), name("flat"), name("ok")
    mood, urgency, topics, programs = name("mood"), name("urgency"), name("topics"), name("programs")
    call, complaint = name("callAnalysis"), name("complaintAnalysis")

    step = df.withColumn(name("doc"), answer_object(F.col(raw)))
    step = step.selectExpr(
        *df.columns, f"{_open(name('doc'), CATEGORIES + ['key_topics', 'primary_topics', 'sentiment', 'urgency'])} AS {top}"
    )
    step = step.selectExpr(
        *df.columns,
        top,
        f"{top} IS NOT NULL AND {top}.callAnalysis IS NULL AS {flat}",
        *[f"{_open(f'{top}.{c}', INSIGHT_FIELDS[c])} AS {name(c)}" for c in CATEGORIES],
    )
    step = step.selectExpr(
        "*",
        f"{_open(f'{complaint}.programSpecificComplaints', ['SD', 'SP', 'SB'])} AS {programs}",
        f"CASE WHEN {flat} THEN {top}.sentiment ELSE {call}.overallSentiment END AS {mood}",
        f"CASE WHEN {flat} THEN {top}.urgency ELSE {call}.urgencyLevel END AS {urgency}",
        f"CASE WHEN {flat} THEN coalesce({top}.key_topics, {top}.primary_topics) ELSE {call}.primaryTopics END AS {topics}",
    )

    leaves, tests, structs = {}, [f"{top} IS NOT NULL"], []
    for category, fields in INSIGHT_FIELDS.items():
        parts = []
        for field, kind in fields.items():
            key = name(category, field)
            if isinstance(kind, dict):
                tests.append(f"({complaint}.{field} IS NULL OR {programs} IS NOT NULL)")
                for sub, sub_kind in kind.items():
                    leaves[f"{key}_{sub}"] = _leaf(sub_kind, f"{programs}.{sub}")
                    tests.append(f"{key}_{sub}.ok")
                inner = ", ".join(f"'{sub}', {key}_{sub}.value" for sub in kind)
                parts.append(f"'{field}', named_struct({inner})")
                continue
            value, good = f"{key}.value", f"{key}.ok"
            if (category, field) == ("callAnalysis", "primaryTopics"):
                leaves[key] = _topic_leaf(topics)
                untold = f"({flat} AND {topics} IS NULL)"
                value, good = f"if({untold}, array('general'), {value})", f"({untold} OR {good})"
            elif (category, field) == ("callAnalysis", "overallSentiment"):
                leaves[key] = _leaf(kind, mood)
                value = f"if({mood} IS NULL, 'neutral', {value})"
            elif (category, field) == ("callAnalysis", "urgencyLevel"):
                leaves[key] = _leaf(kind, urgency)
                value = f"if({flat} AND {urgency} IS NULL, 'low', {value})"
            else:
                leaves[key] = _leaf(kind, f"{name(category)}.{field}")
            tests.append(good)
            parts.append(f"'{field}', {value}")
        tests.append(f"({top}.{category} IS NULL OR {name(category)} IS NOT NULL)")
        structs.append(f"'{category}', named_struct({', '.join(parts)})")
    step = step.selectExpr("*", *[f"{expr} AS {key}" for key, expr in leaves.items()])
    step = step.selectExpr("*", f"coalesce({' AND '.join(tests)}, false) AS {ok}")

    # A generated row is a border for the optimizer: a filter on ``valid`` is evaluated on the
    # finished columns and not rewritten into one huge expression over the raw text.
    reason = f"CASE WHEN {top} IS NULL THEN 'answer holds no JSON object' WHEN NOT {ok} THEN '{V.INVALID_REASON}' END"
    result = (
        f"named_struct('{prefix}valid', {ok}, '{prefix}insight', if({ok}, named_struct({', '.join(structs)}), NULL), "
        f"'{prefix}coerced', {ok} AND {flat}, '{prefix}reason', {reason})"
    )
    return step.selectExpr(*df.columns, f"inline(array({result}))")


def split_by_validity(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the quarantine with the reason."""
    return checked.where("valid"), checked.where("NOT valid").drop("insight")
