"""Exact substring dedup: bytes that repeat a string of ``LENGTH`` bytes which starts earlier in the corpus.

The order of a suffix array up to the depth of ``LENGTH`` bytes is all that is needed, and it is found by a
difference-cover algorithm whose cover is chosen by content:

1. Sample. A string that starts at p is sampled at the place of the least hashed 8 bytes among the ``WINDOW``
   places from p on. Equal strings are sampled at equal distances, so two suffixes can be compared at sampled
   places, as with residues of a difference cover; but one place in 25 is sampled and not two in three.
2. Name. A sampled suffix gets the 128-bit name of its first ``LENGTH - WINDOW + 1`` bytes, read in words of 8.
   Names that occur once in the corpus are dropped: no string there repeats.
3. Recurse. Suffixes of one name are sorted by their remaining bytes up to the depth, in words of 8.
4. Merge. The suffixes between samples follow from the order of the bytes before each sample, read backwards,
   and the order of the sampled suffixes.
5. Compare adjacent prefixes. The common prefix of neighbours in the one order and the common ending of
   neighbours in the other tell which strings are equal; all but the first of them are removed.

Spark deals names out by hash, twice: the names alone to find the repeated ones, then the sampled places with
their bytes. Each task sends a name at most twice, and of equal places (same bytes around, same strings) only
the first, so that copies of a text or passage weigh as many rows as there are tasks. Repeated names go to every
task if there are at most ``HELD_NAMES``; beyond, all sampled places are dealt out, with the same result.

Positions are ordered by doc_id (NULL first), rows of one doc_id by a hash of the text, then bytes. Rows equal in
both are one text after the other. NULL is an empty text; texts under ``LENGTH`` bytes lose nothing. An empty
table gives no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import mixed, written

LENGTH, WINDOW = 100, 50
#: Bytes that every string has from its sampled place on: those of the name.
NAMED = LENGTH - WINDOW + 1
#: Bytes behind the name and before the sampled place that a string may have.
RIGHT, LEFT = LENGTH - NAMED, WINDOW - 1
#: Bytes of text that a task samples at a time; a longer text is read in overlapping slices.
SLICE = 2_000_000
#: Names and places that a task gathers before it sends them.
NAMES_SENT, PLACES_SENT = 4_000_000, 250_000
#: Repeated names that are sent to every task, 8 bytes each.
HELD_NAMES = 8_000_000
#: Bytes of text for each bucket of names.
BUCKET_BYTES = 16_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACE = (1 << 24) - 1


class Places:
    """The sampled places of some slices of text: ``at``, the strings around each as distances ``low`` to ``high``, and names."""

    def __init__(self, slices: list[bytes]):
        text = b"".join(slices) + bytes(LENGTH + 8)
        self.text = np.frombuffer(text, np.uint8)
        self.words = np.ndarray(len(text) - 7, "<u8", text, strides=(1,))
        size = np.fromiter(map(len, slices), np.int64, len(slices))
        self.first = np.cumsum(size) - size
        strings = np.maximum(size - LENGTH + 1, 0)
        starts = np.repeat(self.first - np.cumsum(strings) + strings, strings) + np.arange(strings.sum())
        least = (mixed(self.words * _ODD) & ~np.uint64(_PLACE)) | np.arange(len(self.words), dtype=np.uint64)
        span = 1
        while 2 * span <= WINDOW:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[: len(least) - (WINDOW - span)], least[WINDOW - span :])
        place = (least[starts] & np.uint64(_PLACE)).astype(np.int64)
        begin = np.flatnonzero(np.diff(place, prepend=-1))
        end = np.append(begin[1:], len(place))[: len(begin)] - 1
        self.at = place[begin]
        self.high, self.low = self.at - starts[begin], self.at - starts[end]
        self.slice = np.searchsorted(self.first, starts[begin], side="right") - 1
        self.names = np.empty((2, len(self.at)), np.uint64)
        for k, seed in enumerate((3, 5)):
            name = np.zeros(len(self.at), np.uint64)
            for step in [*range(0, NAMED - 8, 8), NAMED - 8]:
                name = mixed(name * np.uint64(seed) + self.words[self.at + step] + np.uint64(k))
            self.names[k] = name

    def around(self, some: np.ndarray) -> np.ndarray:
        """The bytes behind the name, then those before the place, nearest first; zero where no string reaches."""
        right, left = np.arange(RIGHT), np.arange(LEFT)
        out = np.empty((len(some), RIGHT + LEFT), np.uint8)
        at, low, high = self.at[some, None], self.low[some, None], self.high[some, None]
        out[:, :RIGHT] = np.where(right < RIGHT - low, self.text[at + NAMED + right], 0)
        out[:, RIGHT:] = np.where(left < high, self.text[np.maximum(at - 1 - left, 0)], 0)
        return out


def sampled(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Places, np.ndarray]]:
    """Places of (id, tie, text) batches, with (id, tie, offset of the slice) of each slice."""
    parts: list[bytes] = []
    owner: list[tuple[int, int, int]] = []
    size = 0
    for batch in batches:
        texts = batch.column(2).cast(pa.binary())
        for i in range(batch.num_rows):
            text = texts[i].as_py() or b""
            for offset in range(0, max(len(text) - LENGTH + 1, 0), SLICE):
                part = text[offset : offset + SLICE + LENGTH - 1]
                if size and size + len(part) > SLICE:
                    yield Places(parts), np.array(owner, np.int64)
                    parts, owner, size = [], [], 0
                parts.append(part)
                owner.append((batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), offset))
                size += len(part)
    if parts:
        yield Places(parts), np.array(owner, np.int64)


def _dealt(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    ends = np.flatnonzero(np.diff(bucket[order], append=-1)) + 1
    for some in np.split(order, ends[:-1]) if len(ends) else []:
        yield int(bucket[some[0]]), some


def repeated_names(rows: DataFrame, buckets: int) -> DataFrame:
    """``name``: first halves of the names that occur more than once."""

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed(held: list[np.ndarray]) -> pa.RecordBatch:
            names, n = np.unique(np.concatenate(held), return_counts=True)
            names = np.repeat(names, np.minimum(n, 2))
            dealt = [(b, names[some].tobytes()) for b, some in _dealt((names % np.uint64(buckets)).astype(np.int64))]
            return pa.RecordBatch.from_pydict({"bucket": pa.array([b for b, _ in dealt], pa.int32()), "names": pa.array([x for _, x in dealt], pa.binary())})

        held: list[np.ndarray] = []
        for places, _ in sampled(batches):
            held.append(places.names[0])
            if sum(map(len, held)) >= NAMES_SENT:
                yield flushed(held)
                held = []
        if held:
            yield flushed(held)

    def find(table: pa.Table) -> pa.Table:
        names = np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in table["names"].to_pylist()]))
        same = names[1:][names[1:] == names[:-1]]
        return pa.table({"name": pa.array(np.unique(same).view(np.int64))})

    return rows.mapInArrow(send, "bucket int, names binary").groupBy("bucket").applyInArrow(find, "name long")


def _keys(columns: list[np.ndarray], text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the columns and then the bytes of each line, and the equal bytes of each line and the one before (-1: other columns)."""
    wide = np.zeros((len(text), -(-text.shape[1] // 8) * 8), np.uint8)
    wide[:, : text.shape[1]] = text
    words = wide.view(">u8").astype(np.uint64)
    order = np.lexsort([*words.T[::-1], *columns[::-1]])
    equal = text[order[1:]] == text[order[:-1]]
    common = np.where(equal.all(axis=1), text.shape[1], equal.argmin(axis=1))
    for c in columns:
        common[c[order[1:]] != c[order[:-1]]] = -1
    return order, np.append([-1], common)[: len(text)]


def later_strings(names: np.ndarray, low: np.ndarray, high: np.ndarray, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of places in text order, the least and the greatest distance of a string that starts earlier too (LENGTH, -1 if none does)."""
    n = len(low)
    first, last = np.full(n, LENGTH), np.full(n, -1)
    by_right, common = _keys(list(names), around[:, :RIGHT])
    by_left, ending = _keys(list(names), around[:, RIGHT:])
    right, left = np.empty(n, np.int64), np.empty(n, np.int64)
    for distance in range(WINDOW):
        some = np.flatnonzero((low <= distance) & (distance <= high))
        if not len(some):
            continue
        # neighbours that agree in the string's bytes from the place on, and in those before it, have one class
        right[by_right] = np.cumsum(common < RIGHT - distance)
        left[by_left] = np.cumsum(ending < distance)
        _, begin, member = np.unique(right[some] * (n + 1) + left[some], return_index=True, return_inverse=True)
        later = some[begin[member] < np.arange(len(some))]
        first[later] = np.minimum(first[later], distance)
        last[later] = distance
    return first, last


def _in_text_order(owners: np.ndarray) -> np.ndarray:
    """Order of (id, tie, place) lines, each once: rows equal in id and text are one text here."""
    order = np.lexsort(owners.T[::-1])
    again = np.zeros(len(order), bool)
    again[1:] = (owners[order[1:]] == owners[order[:-1]]).all(axis=1)
    return order[~again]


_PLACES = "bucket int, done boolean, names binary, owners binary, near binary, around binary"
_FOUND = "id long, tie long, start long, end long"


def _sender(buckets: int, held_names):
    """Places whose name is repeated, dealt out by name; of equal ones the first, while the others are spans at once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if held_names is None else held_names.value
        held: list[tuple[np.ndarray, ...]] = []
        turn = 0
        for places, owner in sampled(batches):
            some = np.arange(len(places.at))
            if known is not None:
                at = np.minimum(np.searchsorted(known, places.names[0]), max(len(known) - 1, 0))
                some = np.flatnonzero(known[at] == places.names[0]) if len(known) else some[:0]
            mine = owner[places.slice[some]]
            mine[:, 2] += places.at[some] - places.first[places.slice[some]]
            near = np.stack((places.low[some], places.high[some]), axis=1).astype(np.uint8)
            held.append((places.names[:, some].T, mine, near, places.around(some)))
            if sum(len(x[0]) for x in held) >= PLACES_SENT:
                turn += 1
                yield _sent(held, buckets, turn)
                held = []
        if held:
            yield _sent(held, buckets, turn + 1)

    return run


def _sent(held: list[tuple[np.ndarray, ...]], buckets: int, turn: int) -> pa.RecordBatch:
    names, owners, near, around = (np.ascontiguousarray(np.concatenate(x)) for x in zip(*held, strict=True))
    order = _in_text_order(owners)
    names, owners, near, around = names[order], owners[order], near[order], around[order]
    whole = np.ascontiguousarray(np.concatenate((names.view(np.uint8).reshape(len(names), -1), near, around), axis=1))
    _, first = np.unique(whole.view(np.dtype((np.void, whole.shape[1]))).ravel(), return_index=True)
    later = np.ones(len(names), bool)
    later[first] = False
    rows = []
    for b, some in _dealt((names[~later, 0] % np.uint64(buckets)).astype(np.int64)):
        some = np.flatnonzero(~later)[some]
        rows.append((b, False, names[some].tobytes(), owners[some].tobytes(), near[some].tobytes(), around[some].tobytes()))
    if later.any():
        rows.append((turn % buckets, True, b"", owners[later].tobytes(), near[later].tobytes(), b""))
    types = [pa.int32(), pa.bool_(), *[pa.binary()] * 4]
    columns = zip(*rows, strict=True) if rows else [()] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["bucket", "done", "names", "owners", "near", "around"]
    )


def _find(table: pa.Table) -> pa.Table:
    """Spans of the later strings of a bucket's places, one for each place that has any."""
    out = []
    done = table["done"].to_numpy(zero_copy_only=False)

    def column(name: str, which: np.ndarray, kind, width: int) -> np.ndarray:
        return np.frombuffer(b"".join(table[name].filter(pa.array(which)).to_pylist()), kind).reshape(-1, width)

    owners, near = column("owners", done, np.int64, 3), column("near", done, np.uint8, 2).astype(np.int64)
    out.append(np.column_stack((owners[:, :2], owners[:, 2] - near[:, 1], owners[:, 2] - near[:, 0] + LENGTH)))
    names, owners, near = column("names", ~done, np.uint64, 2), column("owners", ~done, np.int64, 3), column("near", ~done, np.uint8, 2)
    around = column("around", ~done, np.uint8, RIGHT + LEFT)
    _, member, n = np.unique(names[:, 0], return_inverse=True, return_counts=True)
    some = np.flatnonzero(n[member] > 1)
    some = some[_in_text_order(owners[some])]
    first, last = later_strings(names[some].T, near[some, 0], near[some, 1], around[some])
    some, first, last = some[last >= 0], first[last >= 0], last[last >= 0]
    owners = owners[some]
    out.append(np.column_stack((owners[:, :2], owners[:, 2] - last, owners[:, 2] - first + LENGTH)))
    both = np.concatenate(out)
    return pa.table({name: pa.array(np.ascontiguousarray(both[:, k])) for k, name in enumerate(("id", "tie", "start", "end"))})


def repeated_spans(rows: DataFrame, held_names: int = HELD_NAMES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """id, tie, start, end of byte ranges, overlapping ones included, of (id, tie, text) rows."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // bucket_bytes))
    names = written(repeated_names(rows, buckets), "names")
    sent = None
    if names.count() <= held_names:
        known = np.sort(names.toArrow()["name"].to_numpy().view(np.uint64))
        sent = rows.sparkSession.sparkContext.broadcast(known)
    places = rows.mapInArrow(_sender(buckets, sent), _PLACES)
    return places.groupBy("bucket").applyInArrow(_find, _FOUND)


def without_repeats(docs: DataFrame, kept: bool = False, held_names: int = HELD_NAMES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (maximal removed byte ranges) and kept_sha256 of each row; ``kept``: also the bytes left."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(text).alias("tie"), "doc_id", text.alias("text"))
    found = repeated_spans(rows.select("id", "tie", "text"), held_names, bucket_bytes)
    spans = found.groupBy("id", "tie").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    copy = Window.partitionBy("id", "tie").orderBy("id")
    both = rows.withColumn("copy", F.row_number().over(copy)).join(spans, ["id", "tie"], "left")
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            *T.StructType.fromDDL("n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string, kept binary"),
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            out = []
            for i in range(batch.num_rows):
                data = texts[i].as_py()
                if batch.column(2)[i].as_py() > 1:
                    cut = [(0, len(data))] if len(data) >= LENGTH else []
                else:
                    cut = joined(batch.column(3)[i])
                left, at = [], 0
                for start, end in cut:
                    left.append(data[at:start])
                    at = end
                rest = b"".join([*left, data[at:]])
                spans = [{"start": s, "end": e} for s, e in cut]
                out.append((len(data), len(data) - len(rest), spans, hashlib.sha256(rest).hexdigest(), rest if kept else None))
            types = [f.type for f in _arrow(schema)][1:]
            columns = [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)] if out else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    result = both.select("doc_id", "text", "copy", "found").mapInArrow(run, schema)
    return result if kept else result.drop("kept")


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def joined(found: pa.ListScalar) -> list[tuple[int, int]]:
    """Overlapping and touching ranges as one."""
    if not found.is_valid or not len(found.values):
        return []
    start, end = (found.values.field(k).to_numpy() for k in (0, 1))
    order = np.argsort(start)
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.append([True], start[1:] > end[:-1])
    return list(zip(start[new].tolist(), end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)].tolist(), strict=True))
