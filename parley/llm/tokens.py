"""Token files: blocks of patched frame-of-reference integers, written and read back by Spark tasks.

A file holds the token ids of consecutive documents. Layout, all numbers little-endian:

    magic ``PFOR1\\0\\0\\0``
    blocks of ``BLOCK`` ids (the last may be shorter), each
        uint32 minimum, uint8 width, uint16 ids, uint16 exceptions,
        the low ``width`` bits of id - minimum, one after the other, padded to a byte,
        uint16 place of each exception, uint32 id - minimum of each exception
    uint64 start of each block
    int64 doc_id, uint8 present, int64 ids of each document
    uint64 blocks, uint64 documents, uint64 ids, uint64 place of the block index; magic
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import has, parts, written
from parley.settings import work_folder

MAGIC, HEAD, FOOT = b"PFOR1\0\0\0", struct.Struct("<IBHH"), struct.Struct("<QQQQ8s")
BLOCK = 1024
#: Share of a block's ids that the packed width has to hold; the others are exceptions.
PERCENTILE = 0.95
END_ID = 2
#: Distinct pieces of text whose ids a worker remembers, and the longest of them in characters.
REMEMBERED, LONGEST = 1_400_000, 64
#: White space of the tokenizer's splitting rule.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SOURCE = "byte_bpe_50k.json"
#: The UTF-8 bytes of what is not ASCII in it, as numbers.
_WIDE = [int.from_bytes(chr(c).encode()) for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
#: Bytes of text that a task encodes at a time; one longer text is taken alone.
PIECE_BYTES = 4_000_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(_SOURCE)


# --- integers -------------------------------------------------------------------------------------


def pack_blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of ``BLOCK`` ids each; blocks of one width are packed together."""
    full = len(ids) // BLOCK
    out: list[bytes] = [b""] * full
    for at in range(0, full, 64):
        rows = ids[at * BLOCK : min(at + 64, full) * BLOCK].reshape(-1, BLOCK)
        for i, x in enumerate(_pack(rows)):
            out[at + i] = x
    if len(ids) % BLOCK:
        out += _pack(ids[full * BLOCK :].reshape(1, -1))
    return out


def _pack(rows: np.ndarray) -> list[bytes]:
    low = rows.min(axis=1)
    rest = rows - low[:, None]
    need = np.frexp(rest.astype(np.float64))[1].astype(np.uint8)  # bits of each value
    cut = min(int(np.ceil(PERCENTILE * rows.shape[1])), rows.shape[1]) - 1
    width = np.partition(need, cut, axis=1)[:, cut]
    out: list[bytes] = [b""] * len(rows)
    for w in np.unique(width):
        mine = np.flatnonzero(width == w)
        bits = np.unpackbits(rest[mine].astype("<u4").view(np.uint8).reshape(len(mine), rows.shape[1], 4), axis=2, bitorder="little")
        packed = np.packbits(bits[:, :, :w].reshape(len(mine), -1), axis=1, bitorder="little")
        for i, line in zip(mine, packed, strict=True):
            odd = np.flatnonzero(need[i] > w)
            head = HEAD.pack(int(low[i]), int(w), rows.shape[1], len(odd))
            out[i] = head + line.tobytes() + odd.astype("<u2").tobytes() + rest[i, odd].astype("<u4").tobytes()
    return out


def unpack_block(data: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    """The ids of the block at a place, and where it ends."""
    low, width, n, odd = HEAD.unpack_from(data, at)
    at += HEAD.size
    size = (n * width + 7) // 8
    # the eight bytes from the one that a value starts in hold all of its bits
    near = np.ndarray(size, "<u8", data[at : at + size] + bytes(8), strides=(1,)) if size else np.zeros(1, np.uint64)
    first = np.arange(n, dtype=np.uint64) * np.uint64(width)
    rest = near[first >> np.uint64(3)] >> (first & np.uint64(7)) & np.uint64((1 << width) - 1)
    rest = rest.astype(np.uint32)
    at += size
    rest[np.frombuffer(data, "<u2", odd, at)] = np.frombuffer(data, "<u4", odd, at + 2 * odd)
    return rest + np.uint32(low), at + 6 * odd


# --- tokenizer ------------------------------------------------------------------------------------


class Encoder:
    """Token ids of whole texts; each distinct piece of text goes through the tokenizer once.

    A piece starts where a text does, or at the first character of a run of white space, if that is an ASCII one.
    The tokenizer's own splitting never joins characters across the start of a white-space run, so the ids
    of a text are those of its pieces, one after the other. Arrow finds the distinct pieces of many texts
    at a time, and those that are known; a known piece is a row of an Arrow array and not a Python string, as
    a worker has many. The memory of pieces is emptied when full.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.blank = re.compile(f"[{_SPACE}]").match
        # a token of the byte-level vocabulary has a character for each byte, an added one is plain text
        self.bytes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.bytes[i] = len(token)
        for i, token in self.tokenizer.get_added_tokens_decoder().items():
            self.bytes[i] = len(token.content.encode())
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.start, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.flat, self.used = np.zeros(4096, np.uint32), 0

    def _learn(self, new: pa.Array) -> np.ndarray:
        """Remembers pieces; their numbers."""
        texts = new.to_pylist()
        # pieces from white space up to another character stay apart in one text; a text's first and last may not
        outer = np.fromiter((not self.blank(x) or bool(self.blank(x[-1])) for x in texts), bool, len(texts))
        order = np.argsort(outer, kind="stable")
        split, n = len(texts) - int(outer.sum()), len(self.known)
        self.known = pa.concat_arrays([self.known, new.take(pa.array(order))])
        self._keep([texts[i] for i in order[:split].tolist()], n, self._in_one)
        self._keep([texts[i] for i in order[split:].tolist()], n + split, self._each)
        number = np.empty(len(texts), np.int64)
        number[order] = np.arange(n, n + len(texts))
        return number

    def _in_one(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces and their numbers: those of one text, cut where the next piece starts."""
        out = self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)[0]
        ids, ends = np.array(out.ids, np.uint32), np.cumsum(np.fromiter((len(x.encode()) for x in some), np.int64))
        start = np.concatenate((np.zeros(1, np.int64), np.cumsum(self.bytes[ids])))
        cuts = np.searchsorted(start, ends)
        if not np.array_equal(start[cuts], ends):
            return self._each(some)
        return ids, np.diff(cuts, prepend=0)

    def _each(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [x.ids for x in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64)

    def _keep(self, new: list[str], n: int, encoded: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> None:
        """The ids of pieces that are numbered from ``n`` on."""
        for k in range(0, len(new), 8192):
            flat, size = encoded(new[k : k + 8192])
            m = n + len(size)
            while m > len(self.start):
                self.start, self.size = np.resize(self.start, 2 * len(self.start)), np.resize(self.size, 2 * len(self.size))
            while self.used + len(flat) > len(self.flat):
                self.flat = np.resize(self.flat, 2 * len(self.flat))
            self.start[n:m], self.size[n:m] = self.used + np.cumsum(size) - size, size
            self.flat[self.used : self.used + len(flat)] = flat
            self.used += len(flat)
            n = m

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (NULL: empty), one after the other, and the number of each text's ids."""
        first, places, words = cut(texts)
        if len(self.known) > REMEMBERED or self.used > 8 * REMEMBERED:
            self.forget()
        coded = words.dictionary_encode()
        distinct = coded.dictionary
        at = pc.fill_null(pc.index_in(distinct, value_set=self.known), -1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(at < 0)
        far = pc.utf8_length(distinct.take(pa.array(missing))).to_numpy() > LONGEST
        at[missing[~far]] = self._learn(distinct.take(pa.array(missing[~far])))
        flat, start, size = self.flat, self.start, self.size
        if far.any():  # long pieces are encoded each time and not remembered
            ids, lengths = self._each(distinct.take(pa.array(missing[far])).to_pylist())
            n = len(self.known)
            at[missing[far]] = np.arange(n, n + len(lengths))
            start = np.concatenate((start[:n], self.used + np.cumsum(lengths) - lengths))
            size, flat = np.concatenate((size[:n], lengths)), np.concatenate((flat[: self.used], ids))
        at = at[coded.indices.to_numpy()]
        size = size[at]
        ends = np.cumsum(size)
        total = np.concatenate((np.zeros(1, np.int64), ends))
        ids = flat[np.repeat(start[at] - ends + size, size) + np.arange(total[-1])]
        return ids, np.diff(total[np.searchsorted(places, first)])


def cut(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Where texts start (and the last ends) and where their pieces do, in bytes, and the pieces."""
    texts = pa.concat_arrays([pc.fill_null(texts.cast(pa.large_string()), "")])
    _, offsets, data = texts.buffers()
    first = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)
    raw = np.frombuffer(data, np.uint8, int(first[-1])) if data else np.zeros(0, np.uint8)
    blank = (raw - np.uint8(9) < 5) | (raw == 0x20)
    begins = blank.copy()
    begins[1:] &= ~blank[:-1]
    at = np.flatnonzero(begins)
    at = at[raw[at - 1] >= 0x80]  # behind white space that is not ASCII, or another character
    two, three = raw[at - 2], raw[at - 3]
    at = at[(two == 0xC2) | ((three >= 0xE1) & (three <= 0xE3))]
    before = (raw[at - 2].astype(np.int64) << 8) | raw[at - 1]
    begins[at[np.isin(before, _WIDE) | np.isin(raw[at - 3].astype(np.int64) << 16 | before, _WIDE)]] = False
    begins[first[:-1][np.diff(first) > 0]] = True
    places = np.flatnonzero(begins)
    ends = np.append(places, len(raw))
    return first, places, pa.Array.from_buffers(pa.large_string(), len(places), [None, pa.py_buffer(ends.astype(np.int64)), data])


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


# --- files ----------------------------------------------------------------------------------------


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder in the shared store."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class Writer:
    """One token file, written block by block."""

    def __init__(self, path: str, out: pa.NativeFile):
        self.path, self.out, self.at = path, out, len(MAGIC)
        self.starts: list[int] = []
        self.docs: list[tuple[int | None, int]] = []
        self.rest, self.waiting, self.ids = [], 0, 0
        out.write(MAGIC)

    def add(self, doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> None:
        """Documents one after the other; ``ids`` are those of all."""
        self.docs += zip(doc_ids, sizes, strict=True)
        self.rest.append(ids)
        self.waiting += len(ids)
        if self.waiting >= 256 * BLOCK:
            self._blocks(self.waiting - self.waiting % BLOCK)

    def _blocks(self, n: int) -> None:
        ids = np.concatenate(self.rest) if self.rest else np.zeros(0, np.uint32)
        for block in pack_blocks(ids[:n]):
            self.starts.append(self.at)
            self.out.write(block)
            self.at += len(block)
        self.rest, self.waiting, self.ids = [ids[n:]], len(ids) - n, self.ids + n

    def close(self) -> None:
        self._blocks(self.waiting)
        index = self.at
        self.out.write(np.asarray(self.starts, "<u8").tobytes())
        self.out.write(np.asarray([d or 0 for d, _ in self.docs], "<i8").tobytes())
        self.out.write(np.asarray([d is not None for d, _ in self.docs], np.uint8).tobytes())
        self.out.write(np.asarray([n for _, n in self.docs], "<i8").tobytes())
        self.out.write(FOOT.pack(len(self.starts), len(self.docs), self.ids, index, MAGIC))
        self.out.close()


def read_file(src: pa.NativeFile, size: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """Documents of a token file, a few blocks in memory at a time."""
    src.seek(size - FOOT.size)
    blocks, docs, _, index, magic = FOOT.unpack(src.read(FOOT.size))
    if magic != MAGIC:
        raise ValueError("not a token file")
    src.seek(index)
    starts = [*np.frombuffer(src.read(8 * blocks), "<u8").tolist(), index]
    doc_id = np.frombuffer(src.read(8 * docs), "<i8").tolist()
    present = np.frombuffer(src.read(docs), np.uint8).tolist()
    length = np.frombuffer(src.read(8 * docs), "<i8").tolist()
    have, k = np.zeros(0, np.uint32), 0
    for d, p, n in zip(doc_id, present, length, strict=True):
        parts, there = [have], len(have)
        while there < n:
            to = min(k + 64, blocks)
            src.seek(starts[k])
            data, at = src.read(starts[to] - starts[k]), 0
            for _ in range(to - k):
                ids, at = unpack_block(data, at)
                parts.append(ids)
                there += len(ids)
            k = to
        have = np.concatenate(parts) if len(parts) > 1 else have
        yield (d if p else None), have[:n]
        have = have[n:]


FILES = "part int, path string, documents long, ids long"


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes the documents, in ascending order of doc_id (NULL first), and returns the table of files.

    Documents are range-partitioned by doc_id and a hash of the text, so that no id, NULL included, has
    to fit a task; equal ids follow each other in the order of that hash. NULL texts are empty, and
    every document ends with ``end_id``. Repeated rows are written each time. Only files in the returned table
    (itself written) count: what a lost or repeated task has left behind is never read. An empty table
    gives an empty table of files; further columns are ignored.
    """
    path = tokenizer or default_tokenizer()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, store, encoder = None, None, _encoder(path)
        part_id = TaskContext.get().partitionId()
        for batch in batches:
            for part in parts(batch, "text", PIECE_BYTES):
                if writer is None:
                    store, base = open_folder(folder)
                    store.create_dir(base)
                    name = f"{base}/part-{part_id:05d}-{uuid.uuid4().hex[:12]}.pfor"
                    writer = Writer(name, store.open_output_stream(name))
                ids, sizes = encoder.encode(part.column("text"))
                ids = np.insert(ids, np.cumsum(sizes), np.uint32(end_id))
                writer.add(part.column("doc_id").to_pylist(), (sizes + 1).tolist(), ids)
            pa.default_memory_pool().release_unused()  # the worker stays for later stages, with what Arrow keeps
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": part_id, "path": writer.path, "documents": len(writer.docs), "ids": writer.ids}],
                pa.schema([("part", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())]),
            )

    rows = docs.select(has(docs, "doc_id", "long").alias("doc_id"), has(docs, "text", "string").alias("text"))
    rows = rows.withColumn("__hash", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "__hash").sortWithinPartitions("doc_id", "__hash").select("doc_id", "text")
    return written(rows.mapInArrow(write, FILES), "token-files")


def read_token_files(files: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document in a table of files.

    ``start`` is the number of ids before the document over all files: those before its file, from
    the table of files (one row a file), and those before it in the file.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("before", F.coalesce(F.sum("ids").over(before), F.lit(0)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")])
        store, _ = open_folder(folder)
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = []
                with store.open_input_file(path) as src:
                    for doc_id, ids in read_file(src, src.size()):
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)

    # a number of tasks that is given is kept, where small rows would be gathered into one
    dealt = files.repartition(max(files.count(), 1), "path").select("path", "before")
    return dealt.mapInArrow(scan, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_table(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Writes token files to the shared folder and reads them back."""
    folder = work_folder(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, folder, tokenizer), folder)
