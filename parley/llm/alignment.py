"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, text by text and over a corpus.

Tokenizer A is a byte-level BPE, tokenizer B a sentencepiece BPE with byte fallback. A text is read as a space and
the text, as B reads it. Byte offsets at which tokens of both end cut it into groups; a link is a pair of an A and
a B token that end at one offset, so each group ends with one.

Method, interval coalescing: the tokens of A and B are intervals of bytes. All of them are sorted by start, the
running maximum of their ends is taken, and a group breaks where a start reaches it. A task does this for many
pieces of text at once. A piece is a run of white space and what follows up to the next; neither tokenizer joins
bytes across its start, so a text's groups are its pieces' groups, and each distinct piece is tokenized and
coalesced once and remembered.

How often an id pair is linked in the corpus is counted within each task and then by a ``groupBy``. Texts are
tokenized once: their links are a written table, from which both the counts and the sums over each text come. The
counts of pairs go to every task if there are at most ``HELD_PAIRS`` of them, else links and counts are joined.

Defined results: a text that is NULL or empty, or whose joined A or B bytes are not space and text, has no tokens:
zeros, and an empty digest. Repeated rows count as often as they stand there. An empty table gives no rows.
Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import pieces, written

#: Distinct pieces that a worker remembers, and the longest of them in characters.
REMEMBERED, LONGEST = 500_000, 64
#: Pieces that are tokenized as one text.
CHUNK = 8192
#: Counts of id pairs that are sent to every task, 17 bytes each; beyond them links are joined with the counts.
HELD_PAIRS = 4_000_000
#: Links that a task of the counting job gathers before it adds them up.
GATHERED = 4_000_000
# White space of A's splitting rule, and B's sign for a space.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
MARK = "\u2581"
BLANK = {c for c in map(chr, range(0x3001)) if re.match(f"[{SPACE}]", c)}


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def bytes_of_characters() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable ones stand for themselves, the rest follow 255."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def coalesced(starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of every A and every B interval. Groups overlap in no byte and are numbered in order."""
    starts, ends = np.concatenate((starts_a, starts_b)), np.concatenate((ends_a, ends_b))
    order = np.lexsort((ends, starts))
    reached = np.maximum.accumulate(ends[order])
    group = np.zeros(len(order), np.int64)
    group[order[1:]] = np.cumsum(starts[order][1:] >= reached[:-1])
    return group[: len(starts_a)], group[len(starts_a) :]


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the A and B tokens that end at the same byte."""
    _, a, b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
    return a, b


class Vocabulary:
    """Byte length, bytes and decimal digits of every id of one tokenizer."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        digits = [str(i).encode() for i in range(len(tokens))]
        self.digits = np.fromiter(map(len, digits), np.int64, len(tokens))
        self.width = int(self.digits.max(initial=1))
        self.text = np.zeros((len(tokens), self.width + 1), np.uint8)
        for i, d in enumerate(digits):
            self.text[i, : len(d)] = np.frombuffer(d, np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


class Aligner:
    """Groups and links of texts under two tokenizers, remembered by distinct piece."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        known = bytes_of_characters()
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size(True))]
        self.vocab_a = Vocabulary([bytes(known[c] for c in x) if all(c in known for c in x) else x.encode() for x in names])
        self.b = SentencePieceProcessor(model_file=path_b)
        names = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.vocab_b = Vocabulary([bytes([int(x[3:5], 16)]) if self.b.is_byte(i) else x.replace(MARK, " ").encode() for i, x in enumerate(names)])
        # white space that B may join with the characters before it does not begin a piece
        inner = "".join(sorted({c for x in names if len(x) > 1 for c in re.findall(f"[{SPACE}]", x)}))
        more = f"(?:[^{SPACE}]+(?:[{re.escape(inner)}][{SPACE}]*)?)*" if inner else f"[^{SPACE}]*"
        self.find = re.compile(f"[{SPACE}]+{more}").findall
        self.known: dict[str, int] = {}
        self.forget()

    def forget(self) -> None:
        self.known.clear()
        #: Of each piece: its groups as text (None if the bytes differ), tokens and groups; its links are a slice of ``codes``.
        self.groups: list[bytes | None] = []
        self.counts = np.zeros((1024, 3), np.int64)
        self.codes: list[np.ndarray] = []

    def _ids(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a text under A, and of the same text without its first space under B, which adds one."""
        a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(a, np.int64), np.array(self.b.encode(text[1:], num_threads=1), np.int64)

    def _together(self, some: list[str]) -> list[tuple]:
        """(groups, counts, links) of pieces that are tokenized as one text, between two marks that are cut off again."""
        text = " x" + "".join(some) + " x"
        a, b = self._ids(text)
        whole = text.encode()
        if self.vocab_a.joined(a) != whole or self.vocab_b.joined(b) != whole:
            if len(some) == 1:
                return [(None, (0, 0, 0), np.zeros(0, np.int64))]
            half = len(some) // 2
            return self._together(some[:half]) + self._together(some[half:])
        end_a, end_b = np.cumsum(self.vocab_a.size[a]), np.cumsum(self.vocab_b.size[b])
        group_a, group_b = coalesced(end_a - self.vocab_a.size[a], end_a, end_b - self.vocab_b.size[b], end_b)
        bounds = 2 + np.cumsum([0, *(len(x.encode()) for x in some)])
        first_a, first_b = np.searchsorted(end_a, bounds) + 1, np.searchsorted(end_b, bounds) + 1
        if (end_a[first_a - 1] != bounds).any() or (end_b[first_b - 1] != bounds).any():
            raise ValueError("a tokenizer joined characters across the start of a piece")
        at_a, at_b = links(end_a, end_b)
        codes = a[at_a] * len(self.vocab_b.tokens) + b[at_b]
        first_code = np.searchsorted(end_a[at_a], bounds) + 1
        text_of, first_byte = self._text(a, b, group_a, group_b, end_a, end_b, bounds)
        n_a, n_b, n_groups = np.diff(first_a), np.diff(first_b), np.diff(group_a[first_a - 1])
        return [
            (text_of[first_byte[i] : first_byte[i + 1] - 1], (n_a[i], n_b[i], n_groups[i]), codes[first_code[i] : first_code[i + 1]].copy())
            for i in range(len(some))
        ]

    def _text(self, a, b, group_a, group_b, end_a, end_b, bounds) -> tuple[bytes, np.ndarray]:
        """All groups as ``a,a|b,b;`` and where each bound lies in that."""
        ids, group = np.concatenate((a, b)), np.concatenate((group_a, group_b))
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.lexsort((side, group))  # stable: ids stay in order
        side, group = side[order], group[order]
        width = max(self.vocab_a.width, self.vocab_b.width)
        cells = np.zeros((len(ids), width + 1), np.uint8)
        cells[: len(a), : self.vocab_a.width + 1] = self.vocab_a.text[a]
        cells[len(a) :, : self.vocab_b.width + 1] = self.vocab_b.text[b]
        size = np.concatenate((self.vocab_a.digits[a], self.vocab_b.digits[b]))[order]
        cells = cells[order]
        sign = np.full(len(ids), ord(";"), np.uint8)
        sign[:-1][group[1:] == group[:-1]] = ord(",")
        sign[:-1][(group[1:] == group[:-1]) & (side[1:] != side[:-1])] = ord("|")
        cells[np.arange(len(ids)), size] = sign
        used = np.arange(width + 1) <= size[:, None]
        after = np.cumsum(size + 1)
        last = group_a[np.searchsorted(end_a, bounds)]  # the group that ends at each bound
        return cells[used].tobytes(), after[np.searchsorted(group, last, side="right") - 1]

    def learn(self, new: list[str]) -> None:
        ends = [x for x in new if MARK in x or x[-1] in BLANK]
        plain = [x for x in new if MARK not in x and x[-1] not in BLANK]
        for k in range(0, len(plain), CHUNK):
            self._keep(plain[k : k + CHUNK], self._together(plain[k : k + CHUNK]))
        for x in ends:
            self._keep([x], [self._alone(x)])

    def _alone(self, piece: str) -> tuple:
        """The same of a piece that ends its text, or that holds B's sign for a space: its white space must not run on."""
        text = " x" + piece
        a, b = self._ids(text)
        if self.vocab_a.joined(a) != text.encode() or self.vocab_b.joined(b) != text.encode():
            return None, (0, 0, 0), np.zeros(0, np.int64)
        end_a, end_b = np.cumsum(self.vocab_a.size[a]), np.cumsum(self.vocab_b.size[b])
        group_a, group_b = coalesced(end_a - self.vocab_a.size[a], end_a, end_b - self.vocab_b.size[b], end_b)
        bounds = np.array([2, len(text.encode())])
        i, j = np.searchsorted(end_a, 2) + 1, np.searchsorted(end_b, 2) + 1
        at_a, at_b = links(end_a, end_b)
        codes = (a[at_a] * len(self.vocab_b.tokens) + b[at_b])[end_a[at_a] > 2]
        text_of, first = self._text(a, b, group_a, group_b, end_a, end_b, bounds)
        return text_of[first[0] : first[1] - 1], (len(a) - i, len(b) - j, group_a[-1] - group_a[i - 1]), codes

    def _keep(self, new: list[str], found: list[tuple]) -> None:
        n = len(self.groups)
        groups, counts, codes = zip(*found, strict=True)
        self.groups += groups
        self.codes += codes
        while len(self.groups) > len(self.counts):
            self.counts = np.concatenate((self.counts, np.zeros_like(self.counts)))
        self.counts[n : len(self.groups)] = counts
        self.known.update(zip(new, range(n, n + len(new)), strict=True))

    def align(self, texts: list[str | None]) -> Iterator[tuple[bytes, int, int, int, np.ndarray]]:
        """Of each text its groups as text, tokens of A and B, groups, and the code of every link.

        A link's code is A's id times the size of B's vocabulary, plus B's id.
        """
        found = [self.find(f" {x}") if x else [] for x in texts]
        if len(self.known) > REMEMBERED:
            self.forget()
        new = set().union(*found).difference(self.known)
        self.learn(sorted(new))
        for parts in found:
            at = list(map(self.known.__getitem__, parts))
            parts = list(map(self.groups.__getitem__, at))
            if not parts or None in parts:
                yield b"", 0, 0, 0, np.zeros(0, np.int64)
            else:
                codes = np.concatenate(list(map(self.codes.__getitem__, at)))
                yield b";".join(parts), *self.counts[at].sum(axis=0).tolist(), codes
        for x in new:
            if len(x) > LONGEST:
                i = self.known.pop(x)
                self.groups[i], self.codes[i] = b"", np.zeros(0, np.int64)


@lru_cache(maxsize=1)
def _aligner(paths: tuple[str, str]) -> Aligner:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Aligner(*paths)


# --- Spark ------------------------------------------------------------------------------------------

_ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, groups string"


def aligned(docs: DataFrame, paths: tuple[str, str] | None = None, groups: bool = False) -> DataFrame:
    """A row for each row of ``docs``: tokens, groups and links, the digest of its groups, and its links' codes sorted.

    ``groups``: also the groups themselves as ``a1,a2|b1;a3|b2,b3``, the ids of A and of B in each.
    """
    paths = paths or default_tokenizers()
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *T.StructType.fromDDL(_ALIGNED)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(paths)
        kind = _code_type(len(aligner.vocab_a.tokens) * len(aligner.vocab_b.tokens))
        for batch, texts in (some for whole in batches for some in pieces(whole, "text")):
            rows, size = [], 0
            for i, (text, n_a, n_b, n_groups, codes) in enumerate(aligner.align([x.decode() for x in texts])):
                sha = hashlib.sha256(text).hexdigest() if n_a else ""
                rows.append((n_a, n_b, n_groups, len(codes), sha, np.sort(codes).astype(kind).tobytes(), text.decode() if groups else None))
                size += 8 * len(codes) + len(text) * groups
                if size > 8_000_000 or i + 1 == batch.num_rows:
                    ids = batch.column(0).slice(i + 1 - len(rows), len(rows))
                    types = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.string()]
                    columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                    yield pa.RecordBatch.from_arrays([ids, *columns], names=schema.names)
                    rows, size = [], 0

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _code_type(n: int) -> str:
    return "<u4" if n < 1 << 32 else "<i8"


def token_groups(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """A row for each group: doc_id, number, byte range in space and text, ids of A and ids of B."""
    paths = paths or default_tokenizers()
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType), *T.StructType.fromDDL("number long, start long, end long, a_ids array<int>, b_ids array<int>")]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = _aligner(paths).vocab_a.size
        for batch in batches:
            for i in range(batch.num_rows):
                cells = [[list(map(int, s.split(","))) for s in g.split("|")] for g in batch.column(1)[i].as_py().split(";") if g]
                end = np.cumsum([size[a].sum() for a, _ in cells], dtype=np.int64)
                start = np.concatenate(([0], end))[:-1].astype(np.int64)
                ids = pa.array([batch.column(0)[i].as_py()] * len(cells), batch.column(0).type)
                lists = [pa.array([c[k] for c in cells], pa.list_(pa.int32())) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([ids, pa.array(range(len(cells)), pa.int64()), pa.array(start), pa.array(end), *lists], names=schema.names)

    return aligned(docs, paths, groups=True).select("doc_id", "groups").mapInArrow(run, schema)


def pair_counts(rows: DataFrame, size_b: int, kind: str) -> DataFrame:
    """``code, n, best``: how many links of the rows hold an id pair, and whether that is its B id's highest."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held: list[np.ndarray] = []

        def added() -> tuple[np.ndarray, np.ndarray]:
            new, n = np.unique(np.concatenate(held), return_counts=True)
            both, at = np.unique(np.concatenate((codes, new.astype(np.int64))), return_inverse=True)
            total = np.zeros(len(both), np.int64)
            np.add.at(total, at, np.concatenate((counts, n)))
            return both, total

        for batch in batches:
            for blob in batch.column(0).to_pylist():
                held.append(np.frombuffer(blob, kind))
            if sum(map(len, held)) >= GATHERED:
                codes, counts = added()
                held = []
                if len(codes) > GATHERED:
                    yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["code", "n"])
                    codes, counts = codes[:0], counts[:0]
        if held:
            codes, counts = added()
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["code", "n"])

    total = rows.select("links").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    total = written(total.withColumn("b", F.col("code") % size_b), "pairs")
    most = total.groupBy("b").agg(F.max("n").alias("most"))
    return written(total.join(most, "b").select("code", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def with_corpus_counts(docs: DataFrame, paths: tuple[str, str] | None = None, held_pairs: int = HELD_PAIRS) -> DataFrame:
    """``aligned`` with n_best, the links whose pair is its B id's commonest in the corpus, and count_sum over the links."""
    paths = paths or default_tokenizers()
    aligner = _aligner(paths)
    size_b = len(aligner.vocab_b.tokens)
    kind = _code_type(len(aligner.vocab_a.tokens) * size_b)
    rows = written(aligned(docs, paths).drop("groups").withColumn("row", F.monotonically_increasing_id()), "aligned")
    pairs = pair_counts(rows, size_b, kind)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    if pairs.count() <= held_pairs:
        return _summed(rows, pairs, names, kind)
    each = rows.select("row", F.explode(_codes(rows, kind)).alias("code"))
    sums = each.join(pairs, "code").groupBy("row").agg(F.sum(F.col("best").cast("long")).alias("n_best"), F.sum("n").alias("count_sum"))
    none = F.lit(0).cast("long")
    return rows.join(sums, "row", "left").select(*names, F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"))


def _codes(rows: DataFrame, kind: str):
    """The codes of a row's links as an array."""
    step = int(kind[-1])
    places = F.sequence(F.lit(1), F.octet_length("links").cast("int") - step + 1, F.lit(step))
    # hexadecimal digits of a code's bytes, last byte first
    part = lambda i: F.concat(*[F.hex(F.substring(F.col("links"), i + k, F.lit(1))) for k in reversed(range(step))])
    codes = F.transform(places, lambda i: F.conv(part(i), 16, 10).cast("long"))
    return F.when(F.octet_length("links") > 0, codes).otherwise(F.array().cast("array<long>"))


def _summed(rows: DataFrame, pairs: DataFrame, names: list[str], kind: str) -> DataFrame:
    table = pairs.toArrow()
    codes = table["code"].to_numpy()
    order = np.argsort(codes)
    sent = rows.sparkSession.sparkContext.broadcast(
        (codes[order], table["n"].to_numpy()[order], table["best"].to_numpy(zero_copy_only=False)[order])
    )
    schema = T.StructType([*rows.select(*names).schema, *T.StructType.fromDDL("n_best long, count_sum long")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = sent.value
        for batch in batches:
            found = [np.frombuffer(x, kind) for x in batch.column(len(names)).to_pylist()]
            first = np.cumsum([0, *map(len, found)])
            at = np.searchsorted(known, np.concatenate(found).astype(np.int64)) if found else np.zeros(0, np.int64)
            sums = [np.concatenate(([0], np.cumsum(x[at], dtype=np.int64)))[first] for x in (best, n)]
            columns = [pa.array(np.diff(x)) for x in sums]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *columns], names=schema.names)

    return rows.select(*names, "links").mapInArrow(run, schema)
