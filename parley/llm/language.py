"""Language spans of mixed-language texts: scripts, letter statistics and a Viterbi path over the words."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import has, pieces, written

UNKNOWN = "und"
#: Letter triples are counted in so many places, for so many languages; more of them are an error.
PLACES, MAX_LANGUAGES = 1 << 15, 500
#: Cost of a change of language between two words, in nats.
SWITCH = 12.0
#: A language uses a script if at least this share of its letters is in it.
SCRIPT_SHARE = 0.02
#: Entries of a table words x languages that a task holds at a time.
ENTRIES = 8_000_000
#: First and last code point of the ranges that tell scripts apart.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "sinhala": [(0xD80, 0xDFF)],
    "thai": [(0xE00, 0xE7F)],
    "lao": [(0xE80, 0xEFF)],
    "tibetan": [(0xF00, 0xFFF)],
    "burmese": [(0x1000, 0x109F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "ethiopic": [(0x1200, 0x139F)],
    "khmer": [(0x1780, 0x17FF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
NAMES = [*SCRIPTS, "other"]


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: 2 for letters, 1 for marks; the lower-case character; the script."""
    kind, low, script = np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=np.uint32), np.full(0x110000, len(SCRIPTS), np.uint8)
    for c in range(0x110000):
        x = chr(c)
        if (k := unicodedata.category(x)[0]) in "LM":
            kind[c] = 2 if k == "L" else 1
            if len(y := x.lower()) == 1:
                low[c] = ord(y)
    for i, ranges in enumerate(SCRIPTS.values()):
        for first, last in ranges:
            script[first : last + 1] = i
    return kind, low, script


def _with_letter(kind: np.ndarray) -> np.ndarray:
    """Places in runs of letters and marks that hold a letter; marks alone are no word."""
    inside = kind > 0
    step = np.diff(inside.astype(np.int8))
    start, end = np.flatnonzero(step == 1) + 1, np.flatnonzero(step == -1) + 1
    if len(start):
        bare = ~np.logical_or.reduceat(kind == 2, start)
        for i in np.flatnonzero(bare):
            inside[start[i] : end[i]] = False
    return inside


class Letters:
    """Words (runs of letters and marks with a letter among them) of some texts, with the place of each letter triple."""

    def __init__(self, texts: list[bytes]):
        kind, low, script = _characters()
        points = [np.frombuffer(x.decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32) for x in texts]
        self.base = np.concatenate(([0], np.cumsum([len(p) + 1 for p in points])))
        gap = np.zeros(1, np.uint32)
        c = np.concatenate([gap, *[y for p in points for y in (p, gap)]])[: self.base[-1] + 1]
        inside = _with_letter(kind[c])
        c = np.where(inside, low[c], 0)
        self.at = np.flatnonzero(inside)
        triple = c[self.at - 1] * np.uint32(0x9E3779B1) ^ c[self.at] * np.uint32(0x85EBCA77) ^ c[np.minimum(self.at + 1, len(c) - 1)] * np.uint32(0xC2B2AE3D)
        self.place = ((triple ^ (triple >> np.uint32(15))) * np.uint32(0x27D4EB2F) >> np.uint32(17)).astype(np.int64)
        start = np.flatnonzero(np.diff(inside.astype(np.int8)) == 1) + 1
        #: Letters of word i are first[i] up to first[i + 1].
        self.first = np.append(np.searchsorted(self.at, start), len(self.at))
        self.script = script[c[start]]
        self.begin = start - 1
        self.end = self.begin + np.diff(self.first)
        self.word = np.searchsorted(self.begin, self.base)
        self.script_of_letter = script[c[self.at]]


@dataclass
class Model:
    languages: list[str]
    #: Log probability of each place, and whether the language uses the script.
    scores: np.ndarray
    uses: np.ndarray


def learned(docs: DataFrame) -> DataFrame:
    """Letter triples and scripts of each language over all rows: ``lang, feature, n``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                names = part.column("lang").to_pylist()
                letters = Letters(texts)
                for name in set(names):
                    if name not in counts:
                        counts[name] = np.zeros(PLACES + len(NAMES), np.int64)
                number = {name: i for i, name in enumerate(sorted(set(names)))}
                doc = np.repeat(np.arange(len(texts)), np.diff(letters.first[letters.word]))
                mine = np.array([number[x] for x in names])[doc]
                width = PLACES + len(NAMES)
                n = np.bincount(mine * width + letters.place, minlength=width * len(number))
                n += np.bincount(mine * width + PLACES + letters.script_of_letter, minlength=width * len(number))
                for name, i in number.items():
                    counts[name] += n[i * width : (i + 1) * width]
        for name, n in counts.items():
            there = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(there), pa.string()), pa.array(there.astype(np.int32)), pa.array(n[there])], ["lang", "feature", "n"]
            )

    return docs.select("text", "lang").mapInArrow(count, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame) -> Model:
    """A model of all rows with a text and a language; every language is kept, and over ``MAX_LANGUAGES`` are an error."""
    counts = learned(docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()))
    counts = written(counts, "letters")
    languages = sorted(r[0] for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; map them to fewer before learning")
    table = counts.toPandas()
    n = np.zeros((len(languages), PLACES + len(NAMES)))
    if len(table):
        n[table["lang"].map({x: i for i, x in enumerate(languages)}), table["feature"]] = table["n"]
    triples, scripts = n[:, :PLACES], n[:, PLACES:]
    scores = np.log((triples + 0.5) / (triples.sum(axis=1, keepdims=True) + 0.5 * PLACES))
    uses = scripts >= SCRIPT_SHARE * scripts.sum(axis=1, keepdims=True)
    return Model(languages, scores.T.astype(np.float32).copy(), (uses & (scripts > 0)).T.copy())


def word_scores(letters: Letters, model: Model, a: int, b: int) -> np.ndarray:
    """Log probability of words ``a`` up to ``b`` under each language; only the languages of its script are candidates."""
    out = np.zeros((b - a, len(model.languages)), np.float32)
    step = max(ENTRIES // (8 * len(model.languages)), 1)
    for i in range(a, b, step):
        first = letters.first[i : min(i + step, b) + 1]
        mine = out[i - a : i - a + step]
        np.add.reduceat(model.scores[letters.place[first[0] : first[-1]]], first[:-1] - first[0], axis=0, out=mine)
        candidates = model.uses[letters.script[i : i + len(mine)]]
        candidates |= ~candidates.any(axis=1, keepdims=True)
        mine[~candidates] -= np.float32(1e4)
    return out


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of each word; ``first`` bounds the texts, which are stepped through side by side."""
    languages = scores.shape[1]
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    begin, sizes = first[:-1][order], sizes[order]
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")  # texts with more than t words
    back, label = np.empty(scores.shape, np.uint16), np.zeros(len(scores), np.uint16)
    stay, last = np.arange(languages, dtype=np.uint16), np.zeros(len(sizes), np.intp)
    value = np.zeros((active[0] if steps else 0, languages), np.float32)
    for t in range(steps):
        k = active[t]
        if k < len(value):
            last[k : len(value)] = value[k:].argmax(axis=1)
            value = value[:k]
        best = value.argmax(axis=1)
        jump = (value[np.arange(k), best] - np.float32(switch))[:, None]
        moved = value < jump
        at = begin[:k] + t
        back[at] = np.where(moved, best[:, None].astype(np.uint16), stay)
        value = np.where(moved, jump, value) + scores[at]
        if t % 64 == 0:  # only differences within a text count
            value -= value.max(axis=1, keepdims=True)
    last[: len(value)] = value.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        k = active[t]
        at = begin[:k] + t
        label[at] = last[:k]
        last[:k] = back[at, last[:k]]
    return label


RESULT = "lang_pred string, score double, spans array<struct<lang:string,first:int,last:int>>"


def _predict(texts: list[bytes], model: Model) -> list[pa.Array]:
    letters = Letters(texts)
    n, words = len(texts), letters.word
    labels = np.zeros(len(letters.begin), np.uint16)
    weight = np.zeros((n, max(len(model.languages), 1)))
    total = np.zeros_like(weight)
    size = np.diff(letters.first)
    if model.languages:
        limit, a = max(ENTRIES // len(model.languages), 1), 0
        while a < n:
            b = max(int(np.searchsorted(words, words[a] + limit, side="right")) - 1, a + 1)
            scores, first = word_scores(letters, model, words[a], words[b]), words[a : b + 1] - words[a]
            labels[words[a] : words[b]] = viterbi(scores, first)
            filled = np.flatnonzero(np.diff(first))
            if len(filled):
                total[a + filled] = np.add.reduceat(scores, first[:-1][filled], axis=0, dtype=np.float64)
            a = b
        doc = np.repeat(np.arange(n), np.diff(words))
        np.add.at(weight, (doc, labels), size)
    some = weight.sum(axis=1) > 0
    best = weight.argmax(axis=1)
    share = weight.max(axis=1) / np.maximum(weight.sum(axis=1), 1)
    # how sure the whole text is of that language, against the others
    sure = 1 / np.exp(np.minimum(total - total[np.arange(n), best][:, None], 700)).sum(axis=1)
    score = np.where(some, np.clip(share * np.maximum(sure, share), 0, 1), 0.0)
    names = np.array([*model.languages, UNKNOWN], object)
    pred = names[np.where(some, best, len(model.languages))]
    # runs of words with one label
    doc = np.repeat(np.arange(n), np.diff(words))
    new = np.ones(len(labels) if model.languages else 0, bool)
    new[1:] = (labels[1:] != labels[:-1]) | (doc[1:] != doc[:-1]) if len(new) else new[1:]
    at = np.flatnonzero(new)
    ends = np.append(at[1:], len(new)) - 1 if len(at) else at
    origin = letters.base[doc[at]] if len(at) else at
    spans = pa.StructArray.from_arrays(
        [
            pa.array(names[labels[at]].tolist(), pa.string()),
            pa.array((letters.begin[at] - origin).astype(np.int32)),
            pa.array((letters.end[ends] - origin).astype(np.int32) if len(at) else at.astype(np.int32)),
        ],
        ["lang", "first", "last"],
    )
    bounds = np.searchsorted(doc[at] if len(at) else at, np.arange(n + 1)).astype(np.int32)
    return [pa.array(pred.tolist(), pa.string()), pa.array(score), pa.ListArray.from_arrays(pa.array(bounds), spans)]


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """The rows with ``lang_pred``, ``score`` and ``spans``, of which columns with these names are replaced.

    ``spans`` cover the words of the text in order, with the language and the characters from ``first`` up to ``last``.
    ``lang_pred`` is the language with most letters; ``score`` is the share of the letters in its spans,
    lowered where the whole text could be another language. A text that is NULL, empty or without a
    letter is ``und`` with score 0 and no spans, as is every text if nothing could be learned. Ties go
    to the language that comes first by code point. The path runs over whole texts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score", "spans")
    if "text" not in docs.columns:
        docs = docs.withColumn("text", has(docs, "text", "string"))
    names = [f"`{c}`" for c in docs.columns]
    schema = docs.selectExpr(*names, *["CAST(NULL AS %s) AS %s" % tuple(reversed(c.split(" ", 1))) for c in RESULT.split(", ")]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                new = _predict(texts, shared.value)
                yield pa.RecordBatch.from_arrays([*part.columns, *new], [*part.schema.names, "lang_pred", "score", "spans"])

    return docs.mapInArrow(run, schema)


def held_out(key: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether a row is kept from learning; NULL without a key."""
    return F.crc32(key.cast("string").cast("binary")) % folds == fold
