"""Benchmark passages in documents, found with an FM-index for each shard of the corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import NOT_ALNUM, Words, has, pieces, written
from parley.llm.fmindex import FMIndex

WINDOW = 10
#: UTF-8 bytes of benchmark text whose windows a task holds at a time; a larger benchmark goes in several rounds.
BLOCK_BYTES = 8_000_000


class Phrases:
    """The distinct windows of some items, as rows of word numbers, and the items of each."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        words = Words([text for _, text in items], NOT_ALNUM)
        self.vocabulary = np.unique(words.hash)
        symbol = np.searchsorted(self.vocabulary, words.hash) + 1
        counts = np.diff(words.first)
        n = np.where(counts >= window, counts - window + 1, np.minimum(counts, 1))
        item = np.repeat(np.arange(len(items)), n)
        begin = words.first[:-1][item] + np.arange(len(item)) - np.repeat(np.cumsum(n) - n, n)
        length = np.minimum(counts[item], window)
        rows = np.zeros((len(item), window), np.int64)
        for j in range(window):
            on = j < length
            rows[on, j] = symbol[begin[on] + j]
        self.rows, number = np.unique(rows, axis=0, return_inverse=True) if len(rows) else (rows, np.zeros(0, int))
        self.length = (self.rows > 0).sum(axis=1)
        pair = np.unique(np.stack((number.ravel(), item)), axis=1)
        self.first, self.item = np.searchsorted(pair[0], np.arange(len(self.rows) + 1)), pair[1]
        self.names = [name for name, _ in items]
        self.shortest = int(self.length.min()) if len(self.length) else 0


def _found(words: Words, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window, first word and length of every occurrence in a shard.

    Only runs of words that the windows are made of, as long as the shortest window, can hold an
    occurrence; those runs are what the index is built over.
    """
    none = np.zeros(0, np.int64)
    if not len(phrases.rows) or not len(words.hash):
        return none, none, none
    at = np.minimum(np.searchsorted(phrases.vocabulary, words.hash), len(phrases.vocabulary) - 1)
    known = phrases.vocabulary[at] == words.hash
    joined = np.concatenate(([False], known[1:] & known[:-1] & (words.doc[1:] == words.doc[:-1])))
    begin = np.flatnonzero(known & ~joined)
    end = np.flatnonzero(known & ~np.append(joined[1:], False)) + 1
    long = end - begin >= phrases.shortest
    begin, size = begin[long], (end - begin)[long]
    if not len(begin):
        return none, none, none
    # word numbers of the runs one after the other, with a separator behind each
    run = np.repeat(np.arange(len(begin)), size + 1)
    place = np.arange(len(run)) - np.repeat(np.cumsum(size + 1) - size - 1, size + 1)
    word = np.minimum(begin[run] + place, len(words.hash) - 1)
    text = np.where(place < size[run], at[word] + 1, 0)
    index = FMIndex(text, len(phrases.vocabulary))
    low, high = index.search(phrases.rows, phrases.length)
    hit = np.repeat(np.arange(len(low)), high - low)
    rows = low[hit] + np.arange(len(hit)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
    return hit, word[index.locate(rows)], phrases.length[hit]


def _merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that overlap or touch become one."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.concatenate(([True], begin[1:] > end[:-1]))
    return begin[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


SPANS = "array<struct<first_word:int,end_word:int,first_byte:int,end_byte:int>>"


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents with ``n_words``, ``spans`` (merged, in words and in UTF-8 bytes) and ``items``.

    Words are runs of lower-case letters A-Z, digits and characters beyond ASCII. A window is
    ``window`` consecutive words of an item, or all words of a shorter one. NULL or empty texts and
    items have no words. Items that are repeated count once by their id; an item without an id makes
    hits and is named by an empty string. Columns of the input with the names of the result are replaced.

    A task's shard is a few megabytes of text. The benchmark is split by size into blocks that are held
    one a pass, each pass merging its spans into those of the passes before.
    """
    items = benchmark.select(has(benchmark, "item_id", "string").alias("item_id"), F.encode(has(benchmark, "text", "string"), "UTF-8").alias("text"))
    items = items.filter(F.octet_length("text") > 0)
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    docs = docs.drop("n_words", "spans", "items").withColumns(
        {"n_words": F.lit(None).cast("int"), "spans": F.lit(None).cast(SPANS), "items": F.lit(None).cast("array<string>")}
    )
    schema = docs.schema
    for k in range(blocks):
        block = [(r[0] or "", bytes(r[1])) for r in items.filter(number == k).collect()]
        phrases = docs.sparkSession.sparkContext.broadcast(Phrases(block, window))
        docs = docs.mapInArrow(_pass(phrases), schema)
        if k % 4 == 3:
            docs = written(docs, "decontaminate")
    return docs


def _pass(phrases):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "text") if "text" in batch.schema.names else [(batch, [b""] * len(batch))]:
                words = Words(texts, NOT_ALNUM)
                spans, names = _spans(part, words, phrases.value)
                new = {"n_words": pa.array(np.diff(words.first).astype(np.int32)), "spans": spans, "items": names}
                yield pa.RecordBatch.from_arrays(
                    [new[f.name].cast(f.type) if f.name in new else part.column(f.name) for f in part.schema], schema=part.schema
                )

    return run


def _spans(part: pa.RecordBatch, words: Words, phrases: Phrases) -> tuple[pa.Array, pa.Array]:
    hit, word, length = _found(words, phrases)
    doc = words.doc[word] if len(word) else word
    old_spans, old_items = part.column("spans"), part.column("items")
    out: list[list] = [x or [] for x in old_spans.to_pylist()]
    names: list[list] = [x or [] for x in old_items.to_pylist()]
    order = np.argsort(doc, kind="stable")
    hit, word, length, doc = hit[order], word[order], length[order], doc[order]
    where, first = np.unique(doc, return_index=True)
    for d, a, b in zip(where.tolist(), first.tolist(), np.append(first, len(doc))[1:].tolist(), strict=True):
        base = words.first[d]
        begin = np.concatenate((word[a:b], np.array([s["first_word"] + base for s in out[d]], int)))
        end = np.concatenate((word[a:b] + length[a:b], np.array([s["end_word"] + base for s in out[d]], int)))
        begin, end = _merged(begin, end)
        out[d] = [
            {"first_word": int(x - base), "end_word": int(y - base), "first_byte": int(words.start[x] - words.base[d]), "end_byte": int(words.end[y - 1] - words.base[d])}
            for x, y in zip(begin, end, strict=True)
        ]
        item = np.unique(np.concatenate([phrases.item[phrases.first[h] : phrases.first[h + 1]] for h in np.unique(hit[a:b])]))
        names[d] = sorted({*names[d], *(phrases.names[i] for i in item)})
    return pa.array(out, old_spans.type), pa.array(names, old_items.type)


def contamination(found: DataFrame) -> DataFrame:
    """A row for each document: counts of words, hit words and items, and a digest of the items' ids."""
    hit = F.aggregate("spans", F.lit(0), lambda a, s: a + s["end_word"] - s["first_word"])
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        hit.cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def without_passages(found: DataFrame) -> DataFrame:
    """The documents with the spans cut out of their texts; those of which no word is left go."""
    hit = F.aggregate("spans", F.lit(0), lambda a, s: a + s["end_word"] - s["first_word"])
    left = found.filter((hit == 0) | (hit < F.col("n_words")))
    # no second Python step, for which each task would need another worker
    ends = F.concat(F.array(F.lit(0)), F.transform("spans", lambda s: s["end_byte"]))
    begins = F.concat(F.transform("spans", lambda s: s["first_byte"]), F.array(F.octet_length("text")))
    raw = F.col("text").cast("binary")
    kept = F.zip_with(ends, begins, lambda a, b: F.substring(raw, a + 1, b - a).cast("string"))
    text = F.when(F.size("spans") > 0, F.array_join(kept, "")).otherwise(F.col("text"))
    return left.withColumn("text", text).drop("n_words", "spans", "items")
