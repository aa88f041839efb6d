"""Line dedup with two Bloom filters.

A line's key is the line without [\\x20\\x09-\\x0D] at both ends, A-Z lowered.
Keys of at least ``MIN_CHARS`` code points that occur in two documents or more
lose their lines everywhere but in the smallest doc_id that holds them.

1. One scan builds two Bloom filters over all documents: bits of keys seen
   once and of keys seen twice or more (a key counts once a document). Each
   task sends its two filters in compressed segments; per segment they fold
   into one pair, where what two tasks have both seen once is seen twice.
2. A second scan probes every line. Only suspected repeats shuffle, as
   (128-bit key digest, doc_id); a minimum and maximum doc_id per digest
   confirms a repeat exactly and chooses the document that keeps it.
3. The digests to drop join their documents, whose lines are then filtered.

The filter holds ``BITS_PER_LINE`` bits a line, up to ``MAX_BITS`` (its size
is checked before it is broadcast). Beyond that, more lines are suspected than
repeat; past the point where a filter would not rule out any, all lines are
taken as suspects. The result is the same, as step 2 is exact.

Defined cases: null or empty text is one empty line; a null doc_id takes no
part and its row stays as it is; rows that repeat a doc_id are one document
and lose the same keys; an empty table gives an empty result."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm import words
from tessera.llm.common import written

MIN_CHARS = 10
BITS_PER_LINE = 10
PROBES = 4
MAX_BITS = 1 << 29
SEGMENT = 1 << 16        # bytes
SATURATED = 1.0          # bits a line below which a filter rules nothing out

_SPACE = b" \t\n\x0b\x0c\r"


def key_of(line: bytes, least: int = MIN_CHARS) -> bytes | None:
    """The key, or None if it is too short to count."""
    key = line.strip(_SPACE).lower()           # bytes.lower() maps A-Z only
    if len(key) < least or len(key) < 4 * least and len(key.decode()) < least:
        return None
    return key


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _document_digests(batch, least):
    """For each row with a doc_id: the digests of its distinct keys."""
    ids = batch.column("doc_id").to_pylist()
    for i, text in zip(ids, batch.column("text").cast(pa.binary()).to_pylist()):
        if i is not None and text:
            yield i, {digest(k) for k in {key_of(x, least) for x in text.split(b"\n")} if k is not None}


def probes(digests: np.ndarray, bits: int) -> np.ndarray:
    """PROBES bit positions for each (lo, hi) digest."""
    lo, hi = digests[:, 0], digests[:, 1] | np.uint64(1)
    return np.stack([((lo + np.uint64(j) * hi) % np.uint64(bits)).astype(np.int64) for j in range(PROBES)], axis=1)


def _filters(bits, least):
    def run(batches):
        once, twice = np.zeros(bits, bool), np.zeros(bits, bool)
        for batch in batches:
            found = [b"".join(d) for _, d in _document_digests(batch, least)]
            d = np.frombuffer(b"".join(found), np.uint64).reshape(-1, 2)
            if not len(d):
                continue
            lo, index, n = np.unique(d[:, 0], return_index=True, return_counts=True)
            at = probes(d[index], bits)
            again = once[at].all(axis=1) | (n > 1)
            twice[at[again]] = True
            once[at] = True
        if once.any():
            once, twice = np.packbits(once), np.packbits(twice)
            part, a, b = [], [], []
            for s in range(0, len(once), SEGMENT):
                if once[s:s + SEGMENT].any():
                    part.append(s // SEGMENT)
                    a.append(zlib.compress(once[s:s + SEGMENT].tobytes(), 1))
                    b.append(zlib.compress(twice[s:s + SEGMENT].tobytes(), 1))
            for s in range(0, len(part), 64):
                yield pa.record_batch([pa.array(part[s:s + 64], pa.int32()), pa.array(a[s:s + 64], pa.binary()),
                                       pa.array(b[s:s + 64], pa.binary())], ["segment", "once", "twice"])
    return run


def _folded(batches):
    """Rows come sorted by segment; one pair of filters is held at a time."""
    now, once, twice = None, None, None

    def result():
        return pa.record_batch([pa.array([now], pa.int32()), pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary())], ["segment", "twice"])
    for batch in batches:
        for s, a, b in zip(*(batch.column(c).to_pylist() for c in ("segment", "once", "twice"))):
            a, b = np.frombuffer(zlib.decompress(a), np.uint8), np.frombuffer(zlib.decompress(b), np.uint8)
            if s != now:
                if now is not None:
                    yield result()
                now, once, twice = s, a.copy(), b.copy()
            else:
                twice |= b | (once & a)
                once |= a
    if now is not None:
        yield result()


def repeat_filter(docs: DataFrame, n_lines: int, least: int = MIN_CHARS, max_bits: int = MAX_BITS):
    """The filter of keys seen twice as (bits, segments) or None if it would
    rule nothing out. What is returned has at most ``max_bits`` bits."""
    bits = 8 * SEGMENT
    while bits < BITS_PER_LINE * n_lines and bits < max_bits:
        bits *= 2
    if bits < SATURATED * n_lines:
        return None
    parts = docs.mapInArrow(_filters(bits, least), "segment int, once binary, twice binary")
    count = bits // (8 * SEGMENT)
    folded = parts.repartition(min(count, 64), "segment").sortWithinPartitions("segment").mapInArrow(_folded, "segment int, twice binary")
    return bits, {r["segment"]: r["twice"] for r in folded.toLocalIterator()}


def _suspected(shared, least):
    def run(batches):
        bits, segments = shared.value if shared is not None else (0, {})
        seen = {}
        for batch in batches:
            ids, found = [], []
            for i, d in _document_digests(batch, least):
                ids += [i] * len(d)
                found.append(b"".join(d))
            d = np.frombuffer(b"".join(found), np.uint64).reshape(-1, 2)
            if bits and len(d):
                if not seen:
                    whole = np.zeros(bits // 8, np.uint8)
                    for s, packed in segments.items():
                        whole[s * SEGMENT:(s + 1) * SEGMENT] = np.frombuffer(zlib.decompress(packed), np.uint8)
                    seen["bits"] = whole
                at = probes(d, bits)
                keep = ((seen["bits"][at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)
                d, ids = d[keep], np.array(ids, np.int64)[keep]
            if len(d):
                yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(np.ascontiguousarray(d[:, 0]).view(np.int64)),
                                       pa.array(np.ascontiguousarray(d[:, 1]).view(np.int64))], ["doc_id", "lo", "hi"])
    return run


def repeats(docs: DataFrame, least: int = MIN_CHARS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, drop array<struct<lo, hi>>): the key digests each document loses."""
    spark = docs.sparkSession
    words.small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n = docs.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    seen = repeat_filter(docs, n, least, max_bits)
    shared = None if seen is None else spark.sparkContext.broadcast(seen)
    suspects = written(docs.mapInArrow(_suspected(shared, least), "doc_id long, lo long, hi long"), "suspects")
    # written, so that both sides of the join are exchanges and a very common line's rows can be split
    confirmed = written(suspects.groupBy("lo", "hi").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                        .filter("first < last").drop("last"), "repeats")
    return (suspects.join(confirmed, ["lo", "hi"]).filter("doc_id > first")
            .groupBy("doc_id").agg(F.collect_set(F.struct("lo", "hi")).alias("drop")))


def _kept(least):
    def run(batches):
        for batch in batches:
            n_lines, n_dropped, texts = [], [], []
            drops = batch.column("__drop")
            for i, text in enumerate(batch.column("__text").cast(pa.binary()).to_pylist()):
                rows = (text or b"").split(b"\n")
                drop = drops[i].as_py()
                n_lines.append(len(rows))
                if drop:
                    gone = {np.array([x["lo"], x["hi"]], np.int64).tobytes() for x in drop}
                    kept = [x for x in rows if (k := key_of(x, least)) is None or digest(k) not in gone]
                    n_dropped.append(len(rows) - len(kept))
                    texts.append(b"\n".join(kept).decode())
                else:
                    n_dropped.append(0)
                    texts.append((text or b"").decode())
            out = batch.drop_columns(["__text", "__drop"])
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(texts, pa.string())],
                [*out.schema.names, "__lines", "__dropped", "__kept"])
    return run


def dedup_lines(docs: DataFrame, least: int = MIN_CHARS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with columns __lines, __dropped and __kept (the text that stays)."""
    drop = repeats(docs, least, max_bits).select(F.col("doc_id").alias("__id"), F.col("drop").alias("__drop"))
    joined = docs.withColumn("__text", F.col("text")).join(drop, docs["doc_id"] == drop["__id"], "left").drop("__id")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + ["__lines long, __dropped long, __kept string"])
    return joined.mapInArrow(_kept(least), schema)


def dedup_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with its repeated lines gone and n_chars as of the new text; a
    null text stays null. Columns as before."""
    kept = dedup_lines(docs)
    text = F.when(F.col("text").isNull(), F.lit(None)).otherwise(F.col("__kept"))
    out = kept.withColumn("text", text).drop("__lines", "__dropped", "__kept")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
