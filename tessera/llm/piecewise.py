"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last eight UTF-8 bytes triggers a boundary where it
ends a multiple of the block size (3 * 2**level). Each chunk between
boundaries gives one base64 character of its hash; a signature has at most 64,
the last one covering all that is left. A fingerprint is
``level:signature at the level:signature at the next level``. The level starts
from the text's length and goes down while the signature is under half full.

Two fingerprints compare at the block sizes they share: 1 - edit distance /
longer length, the best of the shared ones; 0 if none is shared. Edit distances
of a whole batch run bit-parallel (one 64-bit word a pair).

Neighbours: documents in descending doc_id order are cut into ranges at
approximate quantiles of the ids. Each range sorts in one task; the first
document of each range is also dealt to the range before it, so every row
meets its next one. One shuffle of the documents, no global window.

Defined cases: null text is empty; the fingerprint of the empty text is
``0::``, and two empty texts have likeness 1; null doc_ids count as smallest;
rows that repeat a doc_id are ordered by their text; a single document is its own next one."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm import words
from tessera.llm.common import range_cuts

LEAST = 3
LENGTH = 64
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)   # fixed: base64
MAX_LEVEL = 40

_rng = np.random.default_rng(551)
_ROLL = _rng.integers(0, 2**32, 256, dtype=np.uint32)
_CHUNK = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = int(_rng.integers(2**62, 2**63)) | 1
_INVERSE = pow(_BASE, -1, 2**64)


def _rotl(x, by):
    return (x << np.uint32(by)) | (x >> np.uint32(32 - by))


def triggers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions after which a chunk may end, and the highest level they end
    one at. The window starts anew in each row, so a row's chunks depend on
    its own bytes only."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x = _ROLL[data]
    reach = np.minimum(np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets)), 7).astype(np.int8)
    for by in (1, 2, 4):
        y = np.zeros_like(x)
        y[by:] = x[:-by]
        y[reach < by] = 0
        x = x ^ _rotl(y, by)
    x *= np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    at = np.flatnonzero(x % np.uint32(LEAST) == 0)
    q = (x[at] // np.uint32(LEAST)).astype(np.int64)
    low = q & -q
    level = np.where(q == 0, MAX_LEVEL, np.log2(np.maximum(low, 1)).astype(np.int64))
    return at, level


def _signature(sums, unscale, begin, end, ends):
    """The characters of the chunks of bytes begin..end that end after ``ends``."""
    ends = ends[ends + 1 < end][:LENGTH - 1] + 1
    a = np.concatenate([[begin], ends])
    b = np.concatenate([ends, [end]])
    h = words.mix((sums[b] - sums[a]) * unscale[a] + (b - a).astype(np.uint64))
    return ALPHABET[(h >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprints(texts: list[str]) -> list[str]:
    array = pa.array(texts, pa.large_string())
    data, offsets = words.raw(array)
    out = []
    for i, j in words.blocks(offsets):
        part, off = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        at, level = triggers(part, off)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_CHUNK[part] * words.powers(_BASE, len(part)), out=sums[1:])
        unscale = words.powers(_INVERSE, max(len(part), 1))
        cut = np.searchsorted(at, off)
        for r in range(j - i):
            begin, end = int(off[r]), int(off[r + 1])
            if begin == end:
                out.append("0::")
                continue
            k = 0
            while LEAST * LENGTH << k < end - begin:
                k += 1
            a, lv = at[cut[r]:cut[r + 1]], level[cut[r]:cut[r + 1]]
            while k and np.count_nonzero(lv >= k) + 1 < LENGTH // 2:
                k -= 1
            out.append(f"{k}:{_signature(sums, unscale, begin, end, a[lv >= k])}:{_signature(sums, unscale, begin, end, a[lv >= k + 1])}")
    return out


def edit_distances(a: list[str], b: list[str]) -> np.ndarray:
    """Edit distances of pairs of strings of at most 64 characters of the
    alphabet, by the bit-parallel recurrence over all pairs at once."""
    n = len(a)
    la, lb = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    lookup = np.zeros(256, np.int64)
    lookup[ALPHABET] = np.arange(64)

    def codes(x):
        out = np.zeros((n, LENGTH), np.uint8)
        flat = np.frombuffer("".join(s.ljust(LENGTH, "A") for s in x).encode(), np.uint8).reshape(n, LENGTH) if n else out
        return lookup[flat]
    ca, cb = codes(a), codes(b)
    one = np.uint64(1)
    match = np.zeros((n, 64), np.uint64)
    row = np.arange(n)
    for i in range(int(la.max(initial=0))):
        use = i < la
        match[row[use], ca[use, i]] |= one << np.uint64(i)
    plus, minus, score = np.full(n, np.uint64(2**64 - 1)), np.zeros(n, np.uint64), la.copy()
    top = one << np.maximum(la - 1, 0).astype(np.uint64)
    for j in range(int(lb.max(initial=0))):
        live = (j < lb) & (la > 0)
        eq = match[row, cb[:, j]]
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph, mh = minus | ~(xh | plus), plus & xh
        score = score + np.where(live & ((ph & top) != 0), 1, 0) - np.where(live & ((mh & top) != 0), 1, 0)
        ph = (ph << one) | one
        mh = mh << one
        plus, minus = np.where(live, mh | ~(xv | ph), plus), np.where(live, ph & xv, minus)
    return np.where(la == 0, lb, score)


def likeness(a: list[str], b: list[str]) -> np.ndarray:
    """Likeness 0 to 1 of pairs of fingerprints."""
    x, y = [s.split(":") for s in a], [s.split(":") for s in b]
    best = np.zeros(len(a))
    for p in (1, 2):
        for q in (1, 2):
            same = [i for i in range(len(x)) if int(x[i][0]) + p == int(y[i][0]) + q]
            if same:
                u, v = [x[i][p] for i in same], [y[i][q] for i in same]
                longer = np.array([max(len(s), len(t), 1) for s, t in zip(u, v)])
                best[same] = np.maximum(best[same], 1 - edit_distances(u, v) / longer)
    return best


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by the start of the next one."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def _paired(batches):
    """Rows come sorted by range and, in it, by descending doc_id; a range ends
    with its halo row."""
    held, part = None, None      # the last row and its range

    def result(pairs):
        ids, texts, following = zip(*pairs)
        other = [edited(t, f) for t, f in zip(texts, following)]
        known = {id(t): t for t in (*texts, *following)}       # most are the next pair's text
        prints = dict(zip(known, fingerprints(list(known.values()))))
        own, nxt, new = [prints[id(t)] for t in texts], [prints[id(t)] for t in following], fingerprints(other)
        return pa.record_batch([
            pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in other]), pa.array(own), pa.array(new),
            pa.array(likeness(own, new)), pa.array(likeness(own, nxt))],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
    for batch in batches:
        pairs, size = [], 0
        for p, i, t in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "text"))):
            if held is not None and part == p:
                pairs.append((held[0], held[1], t))
                size += len(held[1]) + len(t)
                if size > words.BLOCK_BYTES:
                    yield result(pairs)
                    pairs, size = [], 0
            held, part = (i, t), p
        if pairs:
            yield result(pairs)


def neighbour_fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of every text, of its edited text and their likenesses."""
    spark = docs.sparkSession
    words.small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select("doc_id")
    cuts = range_cuts(ids, "doc_id", parts)
    # part 0 has the largest ids; a null id sorts after all others
    part = F.lit(len(cuts)) - F.when(F.col("doc_id").isNull(), 0).otherwise(_rank(cuts, "doc_id"))
    heads = {r["part"]: r["head"] for r in ids.groupBy(part.alias("part")).agg(F.max("doc_id").alias("head")).collect()}
    order = sorted(heads)
    before = {p: order[k - 1] for k, p in enumerate(order)}      # the range whose halo is p's first row
    placed = docs.withColumn("part", part)
    halos = []
    if heads:
        heading = spark.createDataFrame([(p, heads[p], before[p]) for p in order], "p int, head long, into int")
        first = (placed.join(F.broadcast(heading), (F.col("part") == F.col("p")) & F.col("doc_id").eqNullSafe(F.col("head")))
                 .groupBy("part", "into").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x"), F.min("doc_id").alias("doc_id")))
        halos = [first.select("doc_id", F.col("x.text").alias("text"), F.col("into").alias("part"), F.lit(1).alias("halo"))]
    dealt = placed.withColumn("halo", F.lit(0))
    for h in halos:
        dealt = dealt.unionByName(h)
    return (dealt.repartition(parts, "part")
            .sortWithinPartitions("part", "halo", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text")
            .select("part", "doc_id", "text").mapInArrow(
                _paired, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                "near_edited double, near_next double"))


def _rank(cuts: list[int], column: str):
    """How many cuts a value reaches."""
    return F.size(F.filter(F.lit(cuts).cast("array<long>"), lambda c: c <= F.col(column))) if cuts else F.lit(0)
