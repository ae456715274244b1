"""Operator 2 - WARC archives: writing, reading and segment reassembly.

``write`` turns rows into WARC/1.1 records: an HTTP response whose body is the
payload in chunked transfer framing, or a revisit of the response that holds an
equal payload.  Blocks above ``SEGMENT_BYTES`` are split: the first segment
keeps the record's type, ``continuation`` records carry the rest with the
origin's id and their number, the last one the total length.  ``read`` parses
archives, gathers the segments of a record by origin id, orders them by number,
checks numbers and total length, decodes the chunked framing and checks the
payload against its digest.  Records in one piece aren't shuffled.

Archives are written by Spark's text writer with the record separator as line
ending, and read as binary files, so any file system of Spark serves.
An archive is unpacked and parsed piece by piece: a task holds about ``READ_BYTES``
of it, or a larger record, however long the file is.

Which record answers for equal payloads is found on (hash, id) rows, aggregated
before the shuffle; payloads never meet by content.  Defined cases: null html is
an empty payload; rows that repeat id and payload give a record each (all
responses, where their id is the largest); a null url is left out; line breaks
in a url are percent-encoded; a row with a null id is a response named by its
digest with an empty page part, read back as a null id, that neither revisits
nor is revisited; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import row_slices, shared_path, text_batches, text_sizes, tidy

SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
#: Most records of an archive, and the payload bytes that it is meant to have: a
#: reading executor holds its packed bytes.  Not smaller than need be: on a local
#: file system Hadoop starts a process (chmod) for each file, which for a moment
#: counts with all the memory of the executor that starts it.
RECORDS_PER_FILE, FILE_BYTES = 20_000, 32 << 20
WRITE_BYTES = 4 << 20
#: Bytes of an archive that a task holds, and of the rows that it returns at a time.
READ_BYTES, PARSED_BYTES = 1 << 20, 4 << 20
VERSION = b"WARC/1.1"
#: Fixed, so that equal inputs give equal archives.
DATE = "2024-01-01T00:00:00Z"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at:at + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if at + size + 2 > len(body) or body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("a chunk ends early")
        out.append(body[at:at + size])
        at += size + 2


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without its closing separator."""
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers if v is not None), b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block


def _uri(page: int | None, digest: str) -> str:
    return f"<urn:page:{_part(page)}:{digest}>"


def _part(page: int | None) -> str:
    return "" if page is None else str(page)


def segments(page: int | None, url: str | None, payload: bytes, refers: int | None, size: int = SEGMENT_BYTES) -> list[bytes]:
    """The records of one row."""
    digest = sha1_base32(payload)
    where = None if url is None else re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url)
    about = [("WARC-Target-URI", where), ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if refers is not None:  # the headers of the full response, without its body
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
        head = [("WARC-Type", "revisit"), ("WARC-Record-ID", _uri(page, digest)), ("WARC-Refers-To", _uri(refers, digest)),
                ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
        return [record(head + about, block)]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    head = [("WARC-Type", "response"), ("WARC-Record-ID", _uri(page, digest))]
    if len(block) <= size:
        return [record(head + about, block)]
    parts = [block[a:a + size] for a in range(0, len(block), size)]
    out = [record([*head, ("WARC-Segment-Number", 1), *about], parts[0])]
    for n, part in enumerate(parts[1:], 2):
        last = [("WARC-Segment-Total-Length", len(block))] if n == len(parts) else []
        out.append(record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:page:{_part(page)}:{digest}:{n}>"), ("WARC-Segment-Origin-ID", _uri(page, digest)),
                           ("WARC-Segment-Number", n), *last, ("WARC-Date", DATE)], part))
    return out


def answering(rows: DataFrame, least_bytes: int) -> DataFrame:
    """Rows (id, hash, refers): the id whose response a row revisits."""
    sized = rows.select("id", "hash", F.octet_length("payload").alias("n")).where(F.col("n") >= least_bytes)
    top = sized.groupBy("hash").agg(F.max("id").alias("refers"), F.min("id").alias("low")).where("low < refers").select("hash", "refers")
    return sized.select("id", "hash").distinct().join(top, "hash").where("id < refers").select("id", "hash", "refers")


def records_per_file(mean_bytes: float) -> int:
    return max(1, min(RECORDS_PER_FILE, int(FILE_BYTES / (mean_bytes + 512))))


def write(rows: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write a record per row below ``path``; of payloads that are equal and
    have at least ``least_bytes``, the largest key's is the response."""
    rows = rows.select(F.col(key).cast("long").alias("id"), F.col(url).alias("url"), F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"))
    records = records_per_file(rows.agg(F.avg(F.octet_length("payload"))).first()[0] or 0.0)
    rows = rows.withColumn("hash", F.sha2("payload", 256))
    named = rows.join(answering(rows, least_bytes), ["id", "hash"], "left").select("id", "url", "payload", "refers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in row_slices(text_sizes(b.column(2)), WRITE_BYTES):
                part = b.slice(lo, hi - lo)
                out = [r for i, u, p, x in zip(*(c.to_pylist() for c in part.columns)) for r in segments(i, u, p, x, segment_bytes)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    text_batches(rows.sparkSession)
    (named.mapInArrow(tidy(run), "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", records).text(path))


def parse(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of the records of an archive: its
    bytes, or a stream that is read piece by piece."""
    read = (io.BytesIO(source) if isinstance(source, bytes) else source).read
    held, at, before = b"", 0, 0  # bytes read, the place in them, bytes dropped before them

    def more(least: int) -> bool:
        """Hold ``least`` bytes more; False at the end of the stream."""
        nonlocal held, at, before
        pieces, found = [held[at:]], 0
        before, at = before + at, 0
        while found < least and (piece := read(max(READ_BYTES, least - found))):
            pieces.append(piece)
            found += len(piece)
        held = b"".join(pieces)
        return found >= least

    while at < len(held) or more(1):
        if len(held) - at < 5:
            more(5)
        while (end := held.find(b"\r\n\r\n", at)) < 0 and held.startswith(b"WARC/", at) and more(1):
            pass
        if end < 0 or not held.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {before + at}")
        lines = held[at:end].decode("utf-8").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size, lead = int(headers["content-length"]), end + 4 - at
        if at + lead + size + 4 > len(held):
            more(at + lead + size + 4 - len(held))
        begin = at + lead
        if held[begin + size:begin + size + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {before + at} ends early")
        yield headers, held[begin:begin + size]
        at = begin + size + 4


def http_payload(block: bytes) -> tuple[bytes, int | None]:
    """(payload, the length that the header names if any) of an HTTP message."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    if fields.get(b"transfer-encoding", b"").lower() == b"chunked":
        return dechunked(body), None
    return body, int(fields[b"content-length"]) if b"content-length" in fields else None


_FIELDS = "record_id string, page_id long, record_type string, refers_to long, url string, payload_digest string, payload_bytes long, payload binary"
_SCHEMA = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
                     ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def _page(uri: str | None) -> int | None:
    part = uri.strip("<>").split(":")[2] if uri else ""
    return int(part) if part else None


def finished(headers: dict[str, str], block: bytes) -> tuple:
    """The row of a whole record."""
    payload, named = http_payload(block)
    kind, digest = headers["warc-type"], headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "revisit":
        size, payload = named, None
    else:
        size = len(payload)
        if digest != sha1_base32(payload):
            raise ValueError(f"{headers['warc-record-id']}: the payload isn't its digest's")
    return (headers["warc-record-id"], _page(headers["warc-record-id"]), kind, _page(headers.get("warc-refers-to")), headers.get("warc-target-uri"), digest, size, payload)


def assemble(pieces: list[tuple[int, dict[str, str], bytes]]) -> list[tuple]:
    """The rows of the segments (number, headers, block) of one origin id; a
    record that was written several times gives as many rows, each with its own url."""
    pieces.sort(key=lambda x: x[0])
    copies = sum(n == 1 for n, _, _ in pieces)
    if not copies or len(pieces) % copies or [n for n, _, _ in pieces] != [1 + i // copies for i in range(len(pieces))]:
        raise ValueError("segments are missing")
    once = pieces[::copies]
    block = b"".join(x for _, _, x in once)
    if int(once[-1][1].get("warc-segment-total-length", -1)) != len(block):
        raise ValueError("the segments' length isn't the total length")
    return [finished(headers, block) for _, headers, _ in pieces[:copies]]


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit below ``path``; a revisit has no payload
    but the length and digest of the one it stands for."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0").select("content")
    split = "origin string, number int, head map<string,string>, block binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                data = content.as_buffer()
                stream = pa.input_stream(pa.BufferReader(data), compression="gzip") if data[:2].to_pybytes() == b"\x1f\x8b" else pa.BufferReader(data)
                rows: list[tuple] = []
                parts: list[tuple] = []
                size = 0
                for headers, block in parse(stream):
                    if "warc-segment-number" in headers:
                        parts.append((headers.get("warc-segment-origin-id", headers["warc-record-id"]), int(headers["warc-segment-number"]), list(headers.items()), block))
                    elif headers["warc-type"] in ("response", "revisit"):
                        rows.append(finished(headers, block))
                    size += len(block)
                    if size > PARSED_BYTES:
                        yield _either(rows, parts)
                        rows, parts, size = [], [], 0
                yield _either(rows, parts)

    text_batches(spark)
    either = f"{_FIELDS}, {split}"
    parsed = files.mapInArrow(tidy(run), either)
    whole = parsed.where("origin is null").select(*_SCHEMA.names)
    pieces = parsed.where("origin is not null").select("origin", "number", "head", "block")

    def join(table: pa.Table) -> pa.Table:
        found = assemble([(n, dict(h), x) for n, h, x in zip(table.column("number").to_pylist(), table.column("head").to_pylist(), table.column("block").to_pylist())])
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), _SCHEMA.types)], schema=_SCHEMA)

    return whole.union(pieces.groupBy("origin").applyInArrow(join, _FIELDS))


def _either(rows: list[tuple], parts: list[tuple]) -> pa.RecordBatch:
    types = [*_SCHEMA.types, pa.string(), pa.int32(), pa.map_(pa.string(), pa.string()), pa.binary()]
    names = [*_SCHEMA.names, "origin", "number", "head", "block"]
    full = [(*r, None, None, None, None) for r in rows] + [(*[None] * len(_SCHEMA.names), *p) for p in parts]
    columns = list(zip(*full)) if full else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def round_trip(rows: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write the rows' archives to the shared folder and read them back."""
    path = shared_path(rows.sparkSession, "warc")
    write(rows, path, key, url, html, least_bytes)
    return read(rows.sparkSession, path)
