"""WARC archives: one gzip member a record, written by Spark tasks and read one record after the other."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import has, written
from parley.llm.tokens import open_folder
from parley.settings import work_folder

#: Bytes after which a task begins another archive, and bytes that are read at a time.
ROLL_BYTES, READ_BYTES = 256 << 20, 1 << 20
#: The date of all records; archives of the same rows are equal.
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = uuid.UUID(int=0)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(identifier: str | None) -> int | None:
    text = (identifier or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A record as a gzip member. The block is the HTTP response; a revisit's has the headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = "".join(c for c in url or "" if c.isprintable())
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {target}"] if target else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{payload_digest(block)}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    head = ("\r\n".join(lines) + "\r\n\r\n").encode()
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def records(src: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a stream, in order.

    Compressed bytes are read a piece at a time and go through one decompressor a member. The block is
    framed by Content-Length; what follows has to be the two line ends of a record, then the end of the
    member. Digests are compared. Anything else raises ValueError. Plain, uncompressed archives are not read.
    """
    rest = b""
    while True:
        rest = rest or src.read(READ_BYTES)
        if not rest:
            return
        member, data = zlib.decompressobj(31), bytearray()
        end = length = -1
        headers: dict[str, str] = {}
        while not member.eof:
            try:
                data += member.decompress(rest, READ_BYTES)
            except zlib.error as error:
                raise ValueError(f"broken gzip member: {error}") from None
            rest = member.unconsumed_tail
            if end < 0 and (end := data.find(b"\r\n\r\n")) >= 0:
                headers = _headers(bytes(data[:end]))
                try:
                    length = int(headers["content-length"])
                except (KeyError, ValueError):
                    raise ValueError("a record has no content length") from None
            if end >= 0 and len(data) > end + 8 + length:
                raise ValueError("a block is longer than its content length")
            if not rest and not member.eof and not (rest := src.read(READ_BYTES)):
                data += member.flush()
                if not member.eof:
                    raise ValueError("the archive ends within a record")
        rest = member.unused_data
        if end < 0 or len(data) != end + 8 + length or data[-4:] != b"\r\n\r\n":
            raise ValueError("a record's length is not its content length")
        block = bytes(data[end + 4 : -4])
        _verify(headers, block)
        yield headers, block


def _headers(head: bytes) -> dict[str, str]:
    first, *lines = head.decode("utf-8").split("\r\n")
    if not first.startswith("WARC/1."):
        raise ValueError("not a WARC record")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _verify(headers: dict[str, str], block: bytes) -> None:
    parts = [("warc-block-digest", block)]
    if headers.get("warc-type") == "response":
        parts.append(("warc-payload-digest", block.partition(b"\r\n\r\n")[2]))
    for name, data in parts:
        kind, _, digest = headers.get(name, "").partition(":")
        if kind.lower() == "sha1" and digest != payload_digest(data):
            raise ValueError(f"{name} differs in record {headers.get('warc-record-id')}")


def http_length(block: bytes) -> int:
    """Content-Length of the HTTP headers in a block."""
    for line in block.partition(b"\r\n\r\n")[0].split(b"\r\n"):
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length":
            return int(value)
    raise ValueError("the HTTP headers have no content length")


def with_decisions(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages with their payload, digest and ``first``: the smallest page_id of those with that payload.

    The smallest ids are aggregated by digest and length and joined back; the side with the pages is
    split by Spark where one payload has many.
    """
    rows = pages.select(
        has(pages, "page_id", "long").alias("page_id"),
        has(pages, "url", "string").alias("url"),
        F.encode(F.coalesce(has(pages, "html", "string"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumns({"digest": F.sha1("payload"), "bytes": F.octet_length("payload")})
    found = rows.filter(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    found = found.filter("n > 1").drop("n")
    return rows.join(found, ["digest", "bytes"], "left")


FILES = "path string, records long, bytes long"


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Writes a record for each row and returns the (written) table of archives.

    A NULL html is an empty payload. Of the rows with equal payloads of at least ``least_bytes``, those
    with the smallest page_id are responses and the others revisit it (rows without an id come last;
    they are responses if no row of the group has an id). Repeated rows get a record each. An empty
    table gives no archive. Archives that a lost or repeated task left are in no table and never read.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_folder(folder)
        store.create_dir(base)
        path, out, count, size = "", None, 0, 0
        schema = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pylist([{"path": path, "records": count, "bytes": size}], schema)

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path, count, size = f"{base}/pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(path, compression=None)
                digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
                revisit = row["first"] is not None and row["page_id"] != row["first"]
                data = record(row["page_id"], row["url"], row["payload"], digest, row["first"], revisit)
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= ROLL_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    rows = with_decisions(pages, least_bytes).select("page_id", "url", "payload", "digest", "first")
    return written(rows.mapInArrow(write, FILES), "archives")


RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def read_archives(files: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """A row for each record of a table of archives; ``payload`` is NULL for revisits, or if not asked for.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload, also for revisits.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_folder(folder)
        names = [x.split()[0] for x in RECORD.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                # or the name's ending would make the stream decompress on its own
                with store.open_input_stream(path, compression=None) as src:
                    for headers, block in records(src):
                        kind = headers["warc-type"]
                        payload = block.partition(b"\r\n\r\n")[2] if payloads and kind == "response" else None
                        rows.append(
                            (
                                page_of(headers["warc-record-id"]),
                                headers.get("warc-target-uri"),
                                kind,
                                http_length(block),
                                headers["warc-payload-digest"].partition(":")[2],
                                page_of(headers.get("warc-refers-to")),
                                payload,
                            )
                        )
                        size += len(payload or b"")
                        if len(rows) == 2000 or size > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return files.repartition(max(files.count(), 1), "path").select("path").mapInArrow(scan, RECORD)


def archived(pages: DataFrame, least_bytes: int = 0, payloads: bool = False) -> DataFrame:
    """Writes archives to the shared folder and reads them back."""
    folder = work_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, least_bytes), folder, payloads)
