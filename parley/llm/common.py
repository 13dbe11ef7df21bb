"""What several of the operators share: written tables, words as arrays, running totals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parley.settings import work_folder

#: Bytes of text that a task turns into arrays at a time; one longer text is a piece of its own.
PIECE_BYTES = 2_000_000
#: Values of a part from which on parts are sorted one by one.
LONG_PART = 200
#: White space of the word pattern [^\x20\x09-\x0D]+.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Everything outside the word pattern [^\x00-\x2F\x3A-\x60\x7B-\x7F]+, after lower-casing.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


#: Spark's setting that removes the shuffle files of a query when it ends, not when the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: What holds while a table is written. Spark's batches for Python have 64 MB otherwise, which the JVM and the worker both hold.
_WRITING = {_CLEANUP: "true", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, read again after a lost executor.

    What the query has shuffled is removed when the table is written.
    """
    spark = df.sparkSession
    path, before = work_folder(spark, label), {k: spark.conf.get(k) for k in _WRITING}
    try:
        for k, v in _WRITING.items():
            spark.conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Removes tables of ``written`` that nothing reads any more."""
    for df in tables:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def has(df: DataFrame, name: str, kind: str) -> Column:
    """A column by its name, NULL if the frame has none."""
    return F.col(f"`{name}`").cast(kind) if name in df.columns else F.lit(None).cast(kind)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.empty(max(n, PIECE_BYTES + 1024), np.uint64)
            p[0], done = 1, 1
            while done < len(p):
                step = min(done, len(p) - done)
                p[done : done + step] = p[:step] * np.uint64(pow(base, done, 1 << 64))
                done += step
            _POWERS[k] = p
    return _POWERS[0][:n], _POWERS[1][:n]


class Words:
    """The lower-cased words of some texts: byte offsets, text number and 64-bit hash of each."""

    def __init__(self, texts: list[bytes], blank: np.ndarray = BLANK):
        self.text = b"\n".join(texts) + b"\n"
        low = LOWER[np.frombuffer(self.text, np.uint8)]
        inside = np.zeros(len(low) + 1, np.int8)
        inside[1:] = ~blank[low]
        change = np.diff(inside)
        self.start, self.end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.base = np.concatenate(([0], np.cumsum(lengths + 1)))
        #: Words of text i are first[i] up to first[i + 1].
        self.first = np.searchsorted(self.start, self.base)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        up, down = _powers(len(low))
        total = np.empty(len(low) + 1, np.uint64)
        total[0] = 0
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
        self._total, self._down = total, down
        self.hash = self.prefix(len(low))

    def prefix(self, size: int) -> np.ndarray:
        """Hash of the first ``size`` bytes of each word."""
        end = np.minimum(self.end, self.start + size)
        return mixed((self._total[end] - self._total[self.start]) * self._down[self.start])

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Text number and hash of each distinct run of ``k`` words, in text order; a shorter text is one run."""
        return self.runs(k, self.doc, self.first)

    def runs(self, k: int, part: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for parts: ``part`` of each word, and the first word of each part."""
        n, counts = len(self.hash), np.diff(first)
        h = np.zeros(max(n - k + 1, 0), np.uint64)
        for j in range(k):
            h = mixed(h * np.uint64(3) + self.hash[j : j + len(h)])
        whole = np.flatnonzero(part[k - 1 :] == part[: len(h)]) if n >= k else np.zeros(0, int)
        short = np.flatnonzero((counts > 0) & (counts < k))
        extra = counts[short].astype(np.uint64)
        for j in range(k - 1):
            more = np.flatnonzero(counts[short] > j)
            extra[more] = mixed(extra[more] * np.uint64(5) + self.hash[first[short[more]] + j])
        doc, h = part[whole], h[whole]
        ends = np.flatnonzero(np.diff(doc, append=-1)) + 1
        if len(h) > LONG_PART * len(ends):
            begin = 0
            for end in ends.tolist():  # sorting each part's values in place is much faster than sorting by part and value
                h[begin:end].sort()
                begin = end
            order = slice(None)
        else:  # but many short parts are told apart at once
            order = np.argsort(mixed(h + doc.astype(np.uint64) * np.uint64(_BASE)))
        keep = np.ones(len(h), bool)
        keep[order] = np.diff(h[order], prepend=~h[order][:1]).astype(bool) | np.diff(doc[order], prepend=-1).astype(bool)
        doc, h = doc[keep], h[keep]
        if len(short):
            doc, h = np.concatenate((doc, short)), np.concatenate((h, extra))
            order = np.argsort(doc, kind="stable")
            doc, h = doc[order], h[order]
        return doc, h


def parts(batch: pa.RecordBatch, text: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``most`` bytes of text each, or one row."""
    begin = size = 0
    for i, n in enumerate(pc.binary_length(batch.column(text)).to_pylist()):
        if size and size + (n or 0) > most:
            yield batch.slice(begin, i - begin)
            begin, size = i, 0
        size += (n or 0) + 1
    if begin < len(batch):
        yield batch.slice(begin)


def pieces(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a batch with at most ``PIECE_BYTES`` of text each, NULL texts empty."""
    for part in parts(batch, text, PIECE_BYTES):
        yield part, [x or b"" for x in part.column(text).cast(pa.binary()).to_pylist()]
    pa.default_memory_pool().release_unused()  # the worker stays for later stages, with what Arrow keeps


def running_before(rows: DataFrame, key: str, hashed: str, order: list[str], value: Column, out: str, bits: int = 12) -> DataFrame:
    """``out``: the sum of ``value`` over the rows of the same ``key`` that come before, ordered by ``hashed``.

    No window covers a whole key: the top ``bits`` of the hash cut each key into slices, an ordinary
    window runs within a slice, and the slices' totals (at most 2**bits rows a key) give the offsets.
    ``key`` has no NULLs. Rows that agree in ``hashed`` and ``order`` are interchangeable.
    """
    rows = rows.withColumn("__slice", F.shiftrightunsigned(hashed, 64 - bits)).withColumn("__value", value)
    totals = rows.groupBy(key, "__slice").agg(F.sum("__value").alias("__sum"))
    before = Window.partitionBy(key).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(key, "__slice", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__offset"))
    within = Window.partitionBy(key, "__slice").orderBy(hashed, *order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.join(offsets, [key, "__slice"])
        .withColumn(out, F.col("__offset") + F.coalesce(F.sum("__value").over(within), F.lit(0)))
        .drop("__slice", "__value", "__offset")
    )


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
