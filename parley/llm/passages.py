"""Repeated passages: equal runs of words wherever they stand, and MinHash bands over paragraphs for near copies.

Every run of 30 words that stands in several texts is found: a text's runs are named by the least hash among their
shorter runs, names that several texts have are counted first, and the runs themselves only where one is shared.
A line of a text is also cut into paragraphs where a sentence ends in a word of even hash. Equal paragraphs are
one class. Classes that collide in a band are compared exactly (words in runs of five, Jaccard 0.8 or more) and
clustered. Words in runs or clusters of several texts make spans; spans of enough words are repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import Words, discard, mixed, pieces, written
from parley.llm.jaccard import bit, different, identity, joined, map_of, named, sketches, verified

WORDS, PERCENT = 5, 80
#: Bands of so many hashes each: a pair at 0.8 collides with probability 1 - (1 - 0.8**2)**5 = 0.994.
BANDS, ROWS = 5, 2
#: Words of the shortest paragraph that is compared and of the shortest span that is a repeat.
LEAST_PARAGRAPH, LEAST_SPAN = 5, 30
#: Words of the shorter runs whose least hash stands for the LEAST_SPAN words that they lie in.
PRINT = 15
#: Columns of a paragraph's sketch; its set is that of a sentence or a few.
SKETCH = [f"p{i}" for i in range(4)]
_SALTS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


class Paragraphs:
    """The paragraphs of some texts that are long enough: text, first word, words and class, and if asked for sketches and band signatures."""

    def __init__(self, texts: list[bytes], signed: bool = True, sketched: bool = True):
        words = Words(texts)
        n, raw = len(words.hash), np.frombuffer(words.text, np.uint8)
        ends = np.zeros(n, bool)
        if n:
            lines = np.concatenate(([0], np.cumsum(raw == 0x0A)))
            ends[:-1] = lines[words.end[:-1]] != lines[words.start[1:]]
            ends |= np.isin(raw[words.end - 1], (0x2E, 0x21, 0x3F)) & (words.hash % np.uint64(2) == 0)
            ends[-1] = True
        first = np.concatenate(([0], np.flatnonzero(ends) + 1)).astype(np.int64)
        part = np.repeat(np.arange(len(first) - 1), np.diff(first))
        unit, shingle = words.runs(WORDS, part, first)
        size, name = identity(unit, shingle, len(first) - 1)
        long = np.diff(first) >= LEAST_PARAGRAPH
        self.text, self.count = words.doc[first[:-1][long]], np.diff(first)[long]
        self.number = np.flatnonzero(long)
        self.first = first[:-1][long] - words.first[self.text]
        self.name, self.size = name[long], size[long].astype(np.int64)
        self.sketch = [x[long] for x in sketches(unit, shingle, len(first) - 1, len(SKETCH))] if sketched else []
        self.bytes = (words.start[first[:-1][long]], words.end[first[1:][long] - 1])
        self.raw = words.text
        if not signed:
            return
        keep = long[unit]
        begin = np.concatenate(([0], np.cumsum(size[long])))[:-1]
        self.signatures = np.zeros((BANDS, len(self.name)), np.int64)
        if len(self.name):
            least = [np.minimum.reduceat(mixed(shingle[keep] ^ salt), begin) for salt in _SALTS]
            for b in range(BANDS):
                x = np.full(len(self.name), b, np.uint64)
                for h in least[b * ROWS : (b + 1) * ROWS]:
                    x = mixed(x * np.uint64(3) + h)
                self.signatures[b] = x.view(np.int64)


def _signed(docs: DataFrame, present: bytes | None = None) -> DataFrame:
    """``sig, id, row, n`` and sketch: band signatures, class, text and set of each paragraph."""
    shared = docs.sparkSession.sparkContext.broadcast(present)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(shared.value, np.uint8) if shared.value else None
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                found, rows = Paragraphs(texts, sketched=known is not None), part.column("row").to_numpy()
                for sig in found.signatures:
                    keep = bit(known, sig) if known is not None else np.ones(len(sig), bool)
                    of_set = (found.name, rows[found.text], *([found.size, *found.sketch] if present else []))
                    yield pa.RecordBatch.from_arrays([pa.array(sig[keep]), *[pa.array(x[keep]) for x in of_set]], columns)

    columns = ["sig", "id", "row", *(["n", *SKETCH] if present else [])]
    return docs.select("row", "text").mapInArrow(run, ", ".join(f"{c} long" for c in columns))


def _listed(docs: DataFrame, ids: DataFrame, texts: bool) -> DataFrame:
    """The paragraphs of some classes, with their places, or with a text of each class."""
    shared = docs.sparkSession.sparkContext.broadcast(map_of(ids, "id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for part, raw in pieces(batch, "text"):
                found = Paragraphs(raw, signed=False, sketched=False)
                keep = np.flatnonzero(bit(known, found.name))
                if texts:
                    text = [found.raw[a:b] for a, b in zip(found.bytes[0][keep].tolist(), found.bytes[1][keep].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(found.name[keep]), pa.array(text, pa.binary()).cast(pa.string())], ["id", "text"])
                else:
                    at = found.text[keep]
                    whole = [part.column("doc_id").take(pa.array(at)), pa.array(part.column("row").to_numpy()[at])]
                    places = [pa.array(x[keep].astype(np.int32)) for x in (found.number, found.first, found.count)]
                    yield pa.RecordBatch.from_arrays([*whole, *places, pa.array(found.name[keep])], ["doc_id", "row", "number", "first", "words", "id"])

    out = "id long, text string" if texts else "doc_id long, row long, number int, first int, words int, id long"
    rows = docs.select("doc_id", "row", "text").mapInArrow(run, out)
    return rows.groupBy("id").agg(F.min("text").alias("text")).join(ids, "id", "left_semi") if texts else rows


def _clusters(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes that share a band signature with another text's paragraph, and components of those that are similar."""
    found = _signed(docs).groupBy("sig").agg(F.min("id").alias("hub"), F.max("id").alias("other"), F.min("row").alias("x"), F.max("row").alias("y"))
    shared = written(found.filter("hub <> other OR x <> y").select("sig", F.expr("hub <> other").alias("varied")), "bands")
    members = _signed(docs, map_of(shared, "sig")).select("sig", "id", "n", *SKETCH)
    members = written(members.join(shared, "sig").distinct(), "band-members")
    discard(shared)
    ids = written(members.select("id").distinct(), "paragraph-classes")
    varied = written(different(members.filter("varied").drop("varied")), "varied")
    discard(members)
    members = varied
    needed = written(members.select("id").distinct(), "needed")
    texts = written(_listed(docs, needed, texts=True), "paragraph-texts")
    discard(needed)
    reached = joined(members, lambda pairs: verified(pairs, texts, WORDS), PERCENT)
    discard(texts)
    return ids, reached


def windows(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, least hash of shorter runs and name of each run of ``LEAST_SPAN`` words within a text."""
    n = len(words.hash) - LEAST_SPAN + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = np.zeros(len(words.hash) - PRINT + 1, np.uint64)
    for j in range(PRINT):
        h = mixed(h * np.uint64(3) + words.hash[j : j + len(h)])
    name = mixed(h[:n] * np.uint64(3) + mixed(h[LEAST_SPAN - PRINT : LEAST_SPAN - PRINT + n]))
    least, width, whole = h, 1, LEAST_SPAN - PRINT + 1
    while width < whole:  # the minimum of twice as many, up to all shorter runs
        step = min(width, whole - width)
        least, width = np.minimum(least[:-step], least[step:]), width + step
    at = np.flatnonzero(words.doc[:n] == words.doc[LEAST_SPAN - 1 :])
    return at, least[at].view(np.int64), name[at].view(np.int64)


def _runs(docs: DataFrame, present: bytes | None = None) -> DataFrame:
    """``sig, row`` of the least hashes of each text; with a map of them ``name, doc_id, row, start`` of the runs that it has."""
    shared = docs.sparkSession.sparkContext.broadcast(present)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(shared.value, np.uint8) if shared.value else None
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                words = Words(texts)
                at, sig, name = windows(words)
                doc = words.doc[at]
                if known is None:
                    keep = np.ones(len(sig), bool)
                    keep[1:] = (sig[1:] != sig[:-1]) | (doc[1:] != doc[:-1])
                    rows = part.column("row").to_numpy()
                    yield pa.RecordBatch.from_arrays([pa.array(sig[keep]), pa.array(rows[doc[keep]])], ["sig", "row"])
                    continue
                keep = bit(known, sig)
                at, doc, name = at[keep], doc[keep], name[keep]
                for i in range(0, len(at), 500_000):
                    d = pa.array(doc[i : i + 500_000])
                    start = (at - words.first[doc])[i : i + 500_000].astype(np.int32)
                    columns = [pa.array(name[i : i + 500_000]), part.column("doc_id").take(d), part.column("row").take(d), pa.array(start)]
                    yield pa.RecordBatch.from_arrays(columns, ["name", "doc_id", "row", "start"])

    out = "name long, doc_id long, row long, start int" if present else "sig long, row long"
    return docs.select("doc_id", "row", "text").mapInArrow(run, out)


def _equal_runs(docs: DataFrame) -> DataFrame:
    """``row, id, runs`` of each text with runs that other texts have: twice the first word of each, and one more if no text before has it."""
    several = _runs(docs).groupBy("sig").agg(F.min("row").alias("x"), F.max("row").alias("y")).filter("x <> y").select("sig")
    prints = written(several, "prints")
    known = map_of(prints, "sig")
    discard(prints)
    found = written(_runs(docs, known), "runs")
    # in two steps within a partition: the least of a struct would sort the runs, and twice
    names = found.select("name", "doc_id", "row").repartition("name").groupBy("name", "doc_id").agg(F.min("row").alias("x"), F.max("row").alias("y"))
    keeper = F.coalesce(F.min_by("x", "doc_id"), F.min("x"))  # texts without an id are last
    names = names.groupBy("name").agg(F.min("x").alias("x"), F.max("y").alias("y"), keeper.alias("keeper"))
    # written, so that the files of this shuffle are gone before the runs are dealt again
    names = written(names.filter("x <> y").select("name", "keeper"), "run-names")
    found = found.join(names, "name").select("row", "doc_id", "start", "keeper")
    at = F.col("start") * 2 + (F.col("keeper") == F.col("row")).cast("int")
    # the runs of one text: at most one for each of its words
    return found.groupBy("row").agg(F.first("doc_id").alias("id"), F.collect_set(at).alias("runs"))


def _order():
    """Texts by id, those without one last."""
    return F.struct(F.col("doc_id").isNull(), "doc_id", "row")


def spans_of(parts: list[tuple[int, int, int, bool]], runs: np.ndarray) -> list[tuple[int, int, list[int], bool]]:
    """``first, last, clusters, removed`` from a text's paragraphs (first, words, cluster, kept) and equal runs.

    Words less than ``LEAST_PARAGRAPH`` apart are in one run, and count if it has ``LEAST_SPAN`` of them.
    """
    kept_run, start = runs % 2 == 1, runs // 2
    first = np.concatenate((np.array([p[0] for p in parts], np.int64), start))
    last = np.concatenate((np.array([p[0] + p[1] for p in parts], np.int64), start + LEAST_SPAN))
    kept = np.concatenate((np.array([p[3] for p in parts], bool), kept_run))
    n = int(last.max(initial=0))

    def cover(mine: np.ndarray) -> np.ndarray:
        return np.cumsum(np.bincount(first[mine], minlength=n + 1) - np.bincount(last[mine], minlength=n + 1))[:n] > 0

    covered, gone = cover(np.ones(len(first), bool)), cover(~kept)
    at = np.flatnonzero(covered)
    if not len(at):
        return []
    begin = np.concatenate(([True], np.diff(at) > LEAST_PARAGRAPH))  # a shorter gap does not end a run
    group = np.cumsum(begin) - 1
    enough = np.bincount(group) >= LEAST_SPAN
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | (gone[at[1:]] != gone[at[:-1]])
    head = np.flatnonzero(new)
    starts, ends = at[head], at[np.append(head[1:], len(at)) - 1] + 1
    clusters: list[dict[int, None]] = [{} for _ in head]
    for a, size, cluster, _ in parts:
        for i in range(int(np.searchsorted(ends, a, "right")), int(np.searchsorted(starts, a + size, "left"))):
            clusters[i][cluster] = None
    return [(int(starts[i]), int(ends[i]), list(clusters[i]), bool(gone[starts[i]])) for i in np.flatnonzero(enough[group[head]])]


SPANS = "doc_id long, row long, first int, last int, clusters array<long>, removed boolean"


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("clusters", pa.list_(pa.int64())), ("removed", pa.bool_())])
    for batch in batches:
        out = []
        for i in range(len(batch)):  # one text at a time
            key, row = batch.column("doc_id")[i].as_py(), batch.column("row")[i].as_py()
            parts = [(p["first"], p["words"], p["cluster"], p["kept"]) for p in batch.column("parts")[i].as_py() or []]
            runs = np.array(batch.column("runs")[i].as_py() or [], np.int64)
            out += [(key, row, *s) for s in spans_of(parts, runs)]
        columns = list(zip(*out, strict=True)) or [[]] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def repeats(docs: DataFrame) -> DataFrame:
    """A row for each repeated span: ``doc_id, row, first, last, clusters, removed``.

    ``first`` up to ``last`` are words (runs of anything but white space) that stand in equal runs of ``LEAST_SPAN`` words
    or similar paragraphs of several texts. ``clusters`` are those of its paragraphs, none if equal runs alone make
    the span. Words are ``removed`` if a text with a smaller doc_id (then ``row``; without an id last) has one of
    their runs or clusters in any place; a span ends where that changes. A text repeats only what another
    row has; rows that are equal in id and text are one. NULL and empty texts have no paragraphs. An empty table
    gives no rows; further columns are ignored. Whole texts are read, and no group is left out.
    """
    docs = named(docs).select("doc_id", "row", "text")
    ids, reached = _clusters(docs)
    rows = _listed(docs, ids, texts=False).join(reached, "id", "left").withColumn("cluster", F.coalesce("component", "id"))
    rows = written(rows.select("doc_id", "row", "number", "first", "words", "cluster"), "paragraphs")
    discard(ids, reached)  # before the runs, of which the shuffle is the largest
    several = rows.groupBy("cluster").agg(F.min("row").alias("x"), F.max("row").alias("y"), F.min_by("row", _order()).alias("keeper"))
    several = several.filter("x <> y").select("cluster", "keeper")
    parts = rows.join(several, "cluster").withColumn("kept", F.col("keeper") == F.col("row"))
    # the paragraphs of one text: their number is that of its lines and sentences
    listed = parts.groupBy("doc_id", "row").agg(F.array_sort(F.collect_set(F.struct("number", "first", "words", "cluster", "kept"))).alias("parts"))
    whole = listed.join(_equal_runs(docs), "row", "full").select(F.coalesce("doc_id", "id").alias("doc_id"), "row", "parts", "runs")
    return whole.mapInArrow(_spans, SPANS)
