"""WARC archives: writing, and reading back with segment reassembly.

Writing: each page is an HTTP response whose entity body is in chunked
transfer framing. A page whose payload digest an earlier page (a smaller
page_id) has becomes a revisit record. Blocks over ``segment_bytes`` are
segmented: the first record is a response with WARC-Segment-Number 1, the rest
are continuation records with WARC-Segment-Origin-ID, the last one with
WARC-Segment-Total-Length. Records end in two CRLF, which is the line
separator of Spark's text writer: the part files are gzip-compressed WARC files
on any store that Spark writes.

Reading: each file is parsed by Content-Length. Records of one segment are
decoded at once; continuation records are grouped by their origin identifier,
ordered by segment number, checked against the total length, joined, and
then decoded from the chunked framing. Payloads are checked against their
records' digests.

Defined cases: null html is the empty payload (written, and equal to any other
empty one); a null page_id is never a first copy unless all copies have null
ids; rows that repeat a page_id and a payload are all responses; payload and
url may hold any text (line ends in a url are percent-coded); a segmented
record with missing parts or a wrong length raises an error."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm import words

#: Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"
RECORD_END = CRLF + CRLF

SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 4 << 10
FILE_RECORDS = 500


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _cut(block: bytes, size: int) -> list[bytes]:
    """Pieces of about ``size`` bytes that do not split a UTF-8 character."""
    out, i = [], 0
    while i < len(block) or not out:
        j = min(i + size, len(block))
        while i < j < len(block) and block[j] & 0xC0 == 0x80:
            j -= 1
        out.append(block[i:j])
        i = j
    return out


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The chunked transfer framing of a body (a chunk holds whole characters)."""
    parts = [b"%x\r\n%s\r\n" % (len(piece), piece) for piece in _cut(body, size) if piece]
    return b"".join(parts) + b"0" + RECORD_END


def unchunked(framed: bytes) -> bytes:
    """The body of a chunked framing (extensions and trailers are skipped)."""
    parts, at = [], 0
    while True:
        end = framed.index(CRLF, at)
        n = int(framed[at:end].split(b";")[0], 16)
        if n == 0:
            return b"".join(parts)
        piece = framed[end + 2:end + 2 + n]
        if len(piece) != n or framed[end + 2 + n:end + 4 + n] != CRLF:
            raise ValueError("chunked framing is cut short")
        parts.append(piece)
        at = end + 4 + n


def record(kind: bytes, record_id: str, fields: list[tuple[bytes, bytes]], block: bytes) -> bytes:
    head = [VERSION, b"WARC-Type: ", kind, CRLF, b"WARC-Record-ID: <", record_id.encode(), b">", CRLF]
    for name, value in fields:
        head += [name, b": ", value, CRLF]
    head += [b"Content-Length: %d" % len(block), RECORD_END]
    return b"".join(head) + block


def page_records(page_id, url, payload: bytes, digest: str, refers_to, is_revisit: bool, date: str,
                 segment_bytes: int = SEGMENT_BYTES) -> list[bytes]:
    """The records of one page."""
    rid = f"urn:uuid:{uuid.uuid4()}"
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A").encode()
    fields = [(b"WARC-Date", date.encode()), (b"WARC-Target-URI", target),
              (b"WARC-Payload-Digest", b"sha1:" + digest.encode()),
              (b"X-Page-ID", b"" if page_id is None else b"%d" % page_id)]
    if is_revisit:
        fields += [(b"WARC-Profile", REVISIT_PROFILE), (b"X-Refers-To-Page-ID", b"" if refers_to is None else b"%d" % refers_to),
                   (b"Content-Type", b"application/http; msgtype=response")]
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
        return [record(b"revisit", rid, fields, block)]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    fields.append((b"Content-Type", b"application/http; msgtype=response"))
    pieces = _cut(block, segment_bytes)
    if len(pieces) == 1:
        return [record(b"response", rid, fields, block)]
    out = [record(b"response", rid, [*fields, (b"WARC-Segment-Number", b"1")], pieces[0])]
    for n, piece in enumerate(pieces[1:], 2):
        more = [(b"WARC-Date", date.encode()), (b"WARC-Segment-Origin-ID", f"<{rid}>".encode()), (b"WARC-Segment-Number", b"%d" % n)]
        if n == len(pieces):
            more.append((b"WARC-Segment-Total-Length", b"%d" % len(block)))
        out.append(record(b"continuation", f"urn:uuid:{uuid.uuid4()}", more, piece))
    return out


def parse(data: bytes):
    """(header fields with lower-case names, block) of each record of a file."""
    at = 0
    while at < len(data):
        if not data.startswith(VERSION, at):
            raise ValueError(f"no record at byte {at}")
        end = data.index(RECORD_END, at)
        fields = {}
        for line in data[at + len(VERSION):end].split(CRLF):
            name, _, value = line.partition(b":")
            fields[name.strip().lower()] = value.strip()
        begin = end + len(RECORD_END)
        stop = begin + int(fields[b"content-length"])
        if data[stop:stop + len(RECORD_END)] != RECORD_END:
            raise ValueError(f"the record at byte {at} has a wrong length")
        yield fields, data[begin:stop]
        at = stop + len(RECORD_END)


def decoded(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, _, body = block.partition(RECORD_END)
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def checked(payload: bytes, digest: str) -> bytes:
    """The payload, if it has the digest its record states."""
    if payload_digest(payload) != digest.removeprefix("sha1:"):
        raise ValueError(f"a payload does not have its digest {digest}")
    return payload


def _written(date, segment_bytes):
    def run(batches):
        for batch in batches:
            html = words.text_array(batch.column("html")).cast(pa.binary()).to_pylist()
            out = []
            for p, u, x, f, r in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), html,
                                     batch.column("first").to_pylist(), batch.column("shared").to_pylist()):
                revisit = bool(r)
                out += page_records(p, u, x, payload_digest(x), f, revisit, date, segment_bytes)
                if len(out) >= 256:
                    yield pa.record_batch([pa.array([b.decode() for b in out])], ["value"])
                    out = []
            yield pa.record_batch([pa.array([b.decode() for b in out], pa.string())], ["value"])
    return run


def write(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", least_bytes: int = 0,
          segment_bytes: int = SEGMENT_BYTES, file_records: int = FILE_RECORDS) -> None:
    """Write (page_id, url, html) as WARC files in the folder ``path``.

    Payloads of at least ``least_bytes`` that are equal to one with a smaller
    page_id become revisits. Only (digest, page_id) shuffle to find them, with
    a minimum per digest before the exchange; the pages join their answer."""
    spark = pages.sparkSession
    words.small_batches(spark, 256)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    keyed = pages.withColumn("sha1", F.sha1(F.coalesce("html", F.lit(""))))
    found = keyed.filter(F.coalesce(F.octet_length("html"), F.lit(0)) >= least_bytes).select(F.col("page_id").alias("id"), "sha1")
    first = found.groupBy("sha1").agg(F.min("id").alias("first"), F.count("*").alias("c")).filter("c > 1").drop("c")
    later = (found.join(first, "sha1").filter("NOT id <=> first").distinct()
             .select("id", "first", F.col("sha1").alias("key")))
    joined = keyed.join(later, keyed["page_id"].eqNullSafe(later["id"]) & (keyed["sha1"] == later["key"]), "left")
    joined = joined.select("page_id", "url", "html", "first", F.col("key").isNotNull().alias("shared"))
    (joined.mapInArrow(_written(date, segment_bytes), "value string").write.option("lineSep", "\r\n\r\n")
     .option("maxRecordsPerFile", file_records).option("compression", "gzip").text(path))


def _parsed(batches):
    names = ["origin", "segment", "total", "record_type", "page_id", "url", "digest", "refers_to", "payload", "length"]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64()]

    def number(x):
        return int(x) if x else None

    def table(rows):
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
    for batch in batches:
        for data in batch.column("content"):
            rows = []
            data = data.as_buffer().to_pybytes()
            for f, block in parse(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                kind = f[b"warc-type"].decode()
                segment = number(f.get(b"warc-segment-number"))
                length = None
                if kind == "revisit":
                    head = block.lower()
                    at = head.index(b"content-length:") + 15
                    length, block = int(head[at:head.index(CRLF, at)]), None
                elif segment is None:
                    block = checked(decoded(block), f[b"warc-payload-digest"].decode())
                origin = f.get(b"warc-segment-origin-id", f[b"warc-record-id"]).strip(b"<>").decode()
                text = {k: f[k].decode() if k in f else None for k in (b"warc-target-uri", b"warc-payload-digest")}
                rows.append((origin, segment, number(f.get(b"warc-segment-total-length")), kind, number(f.get(b"x-page-id")),
                             text[b"warc-target-uri"], (text[b"warc-payload-digest"] or "").removeprefix("sha1:") or None,
                             number(f.get(b"x-refers-to-page-id")), block, length))
                if len(rows) >= 128:
                    yield table(rows)
                    rows = []
            if rows:
                yield table(rows)


def _joined(batches):
    for batch in batches:
        out = []
        for parts, total, digest in zip(*(batch.column(c).to_pylist() for c in ("parts", "total", "digest"))):
            block = b"".join(p["payload"] for p in parts)
            if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)) or total != len(block):
                raise ValueError(f"segments {[p['segment'] for p in parts]} have {len(block)} bytes of {total}")
            out.append(checked(decoded(block), digest))
        yield pa.RecordBatch.from_arrays([*batch.drop_columns(["parts", "total"]).columns, pa.array(out, pa.binary())],
                                         [*batch.drop_columns(["parts", "total"]).schema.names, "payload"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, record_type, refers_to, digest, length, payload) of each
    page record in the archives; payload is null for revisits, whose length
    comes from the stored HTTP headers."""
    words.small_batches(spark, 256)
    files = spark.read.format("binaryFile").load(path).select("content")
    found = files.mapInArrow(_parsed, "origin string, segment int, total long, record_type string, page_id long, url string, "
                             "digest string, refers_to long, payload binary, length long")
    columns = ["page_id", "url", "record_type", "refers_to", "digest", "length", "payload"]
    whole = found.filter("segment IS NULL").select(columns)
    groups = found.filter("segment IS NOT NULL").groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("segment", "payload"))).alias("parts"), F.max("total").alias("total"),
        *[F.min_by(c, "segment").alias(c) for c in ("page_id", "url", "record_type", "refers_to", "digest")])
    segmented = groups.select("page_id", "url", "record_type", "refers_to", "digest", "parts", "total").mapInArrow(
        _joined, "page_id long, url string, record_type string, refers_to long, digest string, payload binary")
    return whole.unionByName(segmented.withColumn("length", F.lit(None).cast("long")).select(columns))
