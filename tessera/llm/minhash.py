"""MinHash near-dedup by fast similarity sketching.

A document's set is its distinct 5-word shingles (64-bit hashes of lower-cased
words; the whole sequence if there are fewer words; empty without words).

* Sketch: T coordinates. In round i < T each element is dealt to one hashed
  bin with value i + hash; a bin keeps its least value, so earlier rounds win.
  Rounds go on while a bin is empty; rounds T..2T-1 give every element to bin
  i - T, which fills each coordinate. A coordinate agrees with probability
  equal to the Jaccard similarity, with concentration of the sum.
* Banding: BANDS x ROWS coordinates. At similarity 0.75 a pair shares no band
  with probability (1 - 0.75**4)**32 = 5e-6.
* Equal sets collapse to their smallest doc_id first (128-bit set sums), so
  copies are never paired.
* Exact verification: 100 * |A and B| >= 75 * |A or B| on whole sets. A
  bucket is not expanded to pairs: its members are first verified against its
  smallest member only. Where a bucket then still holds several components, all
  pairs across them are looked for inside tasks (by their rarest shingles,
  over blocks of bounded size) and only links that join components leave a task.

Defined cases: null or wordless text has an empty set and no links; a null
doc_id links with nothing and gets a null component; rows that repeat a doc_id
are one document with several sets; an empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm import words
from tessera.llm.common import components, written

K = 5
PERCENT = 75
T = 128
ROWS = 4
BANDS = T // ROWS
HASH_BYTES = 6           # of a shingle's hash in stored sets: 5e-10 odds of a collision in 400 shingles
CELL = 300_000           # shingles of one side of a block of a bucket

_rng = np.random.default_rng(7331)
_SEEDS = _rng.integers(1, 2**63, 2 * T, dtype=np.uint64)
_EMPTY = np.uint64(2**64 - 1)


def shingle_sets(array: pa.Array, k: int = K) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each block of rows: its row range, the sorted distinct shingle
    hashes of its rows one after another, and the first one of each row."""
    for i, j, h, first in words.rows_words(array, words.NON_SPACE):
        g, begin = words.grams(h, first, k)
        sets = []
        for r in range(j - i):
            n = first[r + 1] - first[r]
            if n >= k:
                sets.append(np.unique(g[begin[r]:begin[r + 1]]))
            elif n:
                whole = np.array([0x51AB1E + int(n)], np.uint64)
                for x in h[first[r]:first[r + 1]]:
                    whole = words.mix(whole * np.uint64(31) + x)
                sets.append(whole)
            else:
                sets.append(np.zeros(0, np.uint64))
        yield i, j, np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])])


def sketch(u: np.ndarray, first: np.ndarray, t: int = T) -> np.ndarray:
    """The sketches of the sets u[first[r]:first[r + 1]], one row each."""
    n = len(first) - 1
    out = np.full((n, t), _EMPTY, np.uint64)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(n), np.diff(first))
    open_rows = np.diff(first) > 0
    for i in range(2 * t):
        if i:
            open_rows &= (out == _EMPTY).any(axis=1)
        if not open_rows.any():
            break
        if i and not open_rows[owner].all():
            keep = open_rows[owner]
            u, owner = u[keep], owner[keep]
        h = words.mix(u ^ _SEEDS[i])
        value = (np.uint64(i) << np.uint64(55)) | (h >> np.uint64(9))
        if i < t:
            np.minimum.at(flat, owner * t + (h % np.uint64(t)).astype(np.int64), value)
        else:
            np.minimum.at(flat, owner * t + (i - t), value)
    return out


def band_keys(s: np.ndarray, rows: int = ROWS) -> np.ndarray:
    out = np.zeros((len(s), s.shape[1] // rows), np.uint64)
    for r in range(rows):
        out = words.mix(out * np.uint64(0x9E3779B97F4A7C15) + s[:, r::rows][:, :out.shape[1]])
    return words.mix(out + np.arange(out.shape[1], dtype=np.uint64)).view(np.int64)


@words.tidy
def _sketched(batches):
    for batch in batches:
        text = words.text_array(batch.column("text"))
        n, s1, s2, bands = [], [], [], []
        for _, _, u, first in shingle_sets(text):
            sizes = np.diff(first)
            for salt, into in ((1, s1), (2, s2)):
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.mix(u ^ _SEEDS[salt]), dtype=np.uint64)])
                into.append((sums[first[1:]] - sums[first[:-1]]).view(np.int64))
            n.append(sizes)
            bands.append(band_keys(sketch(u, first)))
        if n:
            flat = np.concatenate(bands).reshape(-1)
            yield pa.record_batch([
                batch.column("doc_id"), pa.array(np.concatenate(n), pa.int64()), pa.array(np.concatenate(s1)),
                pa.array(np.concatenate(s2)),
                pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, BANDS), pa.int32()), pa.array(flat))],
                ["doc_id", "n", "s1", "s2", "bands"])


def pack(u: np.ndarray) -> bytes:
    """The low bytes of a set's hashes."""
    return u.view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES].tobytes()


def unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // HASH_BYTES, 8), np.uint8)
    out[:, :HASH_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, HASH_BYTES)
    return out.view(np.uint64).reshape(-1)


def _packed(batches):
    for batch in batches:
        text = words.text_array(batch.column("text"))
        out = []
        for i, j, u, first in shingle_sets(text):
            out += [pack(u[first[r]:first[r + 1]]) for r in range(j - i)]
        if out:
            yield pa.record_batch([batch.column("doc_id"), pa.array(out, pa.binary())], ["id", "members"])


def _confirmed(batches):
    for batch in batches:
        keep = []
        for p, q in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
            p, q = unpack(p), unpack(q)
            both = len(p) + len(q) - len(np.unique(np.concatenate([p, q])))
            keep.append(100 * both >= PERCENT * (len(p) + len(q) - both))
        out = batch.filter(pa.array(keep, pa.bool_()))
        yield pa.RecordBatch.from_arrays([out.column("part"), out.column("other")], ["a", "b"])


def cross_links(parts: list[int], sets: list[np.ndarray], side: list[int]) -> list[tuple[int, int]]:
    """Links between components that join them, from all pairs of sets of
    different components (across the two sides, if there are two).

    Sets list their shingles with the block's rarest first. Two sets that reach the
    similarity share one of the first n - ceil(0.75 n) + 1 of both, so only
    pairs that share such a shingle are counted, exactly and one set against
    its candidates at a time: memory grows with the block's shingles alone."""
    part, sizes, side = np.array(parts), np.array([len(x) for x in sets]), np.array(side)
    own, part = np.unique(part, return_inverse=True)
    if side.min() != side.max():
        left, listed = np.flatnonzero(side == side.min()), side == side.max()
    else:
        # members of the commonest component need not meet each other
        left, listed = np.flatnonzero(part != np.bincount(part).argmax()), np.ones(len(part), bool)
    flat = np.concatenate(sets)
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    column = column[np.lexsort((column, count[column], owner))]
    first = np.cumsum(sizes) - sizes
    fronts = sizes + PERCENT * -sizes // 100 + 1
    front = (np.arange(len(flat)) - first[owner] < fronts[owner]) & (count[column] > 1)
    front_end = first + np.bincount(owner[front], minlength=len(sets))
    lone = np.bincount(owner[(count[column] == 1)], minlength=len(sets))
    posted = np.flatnonzero(front & listed[owner])
    posted = posted[np.argsort(column[posted], kind="stable")]
    begin = np.searchsorted(column[posted], np.arange(len(count) + 1))
    posted = owner[posted]
    up = np.arange(len(own))

    def roots(x):
        r = up[x]
        while (r != up[r]).any():
            r = up[r]
        up[x] = r
        return r
    out, met, mark = [], np.zeros(len(sets), bool), np.zeros(len(count), np.int32)
    for i in left.tolist():
        met[i] = True
        # shingles that no other set has come first and lead nowhere
        near = [posted[begin[c]:begin[c + 1]] for c in column[first[i] + lone[i]:front_end[i] + lone[i]].tolist()]
        if not near:
            continue
        near = np.unique(np.concatenate(near))
        n, m = sizes[near], sizes[i]
        near = near[~met[near] & (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m))]
        near = near[roots(part[near]) != roots(part[i:i + 1])]
        if not len(near):
            continue
        n = sizes[near]
        ahead = np.cumsum(n) - n
        mine = column[first[i]:first[i] + m]
        mark[mine] = 1
        both = np.add.reduceat(mark[column[np.repeat(first[near] - ahead, n) + np.arange(n.sum())]], ahead)
        mark[mine] = 0
        for j in near[100 * both >= PERCENT * (n + m - both)].tolist():
            x, y = int(roots(part[i:i + 1])[0]), int(roots(part[j:j + 1])[0])
            if x != y:
                up[max(x, y)] = min(x, y)
                out.append((int(own[part[i]]), int(own[part[j]])))
    return out


@words.tidy
def _joined(batches):
    """Rows come sorted by block; one block's sets are held at a time."""
    now, parts, sets, side = None, [], [], []

    def result():
        links = cross_links(parts, sets, side) if len(set(parts)) > 1 else []
        return pa.record_batch([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], ["a", "b"])
    for batch in batches:
        for bucket, lo, hi, own, part, members in zip(*(batch.column(c).to_pylist() for c in ("bucket", "lo", "hi", "own", "part", "members"))):
            if (bucket, lo, hi) != now:
                if sets:
                    yield result()
                now, parts, sets, side = (bucket, lo, hi), [], [], []
            parts.append(part)
            sets.append(unpack(members))
            side.append(own)
    if sets:
        yield result()


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between the components ``part`` and ``other`` of those
    pairs that reach the similarity on whole sets."""
    return (pairs.join(sets.select(F.col("id").alias("a"), F.col("members").alias("x")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("members").alias("y")), "b")
            .select("part", "other", "x", "y").mapInArrow(_confirmed, "a long, b long"))


def _alike(n: str, m: str):
    """No smaller set can reach the similarity."""
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``."""
    spark = docs.sparkSession
    words.small_batches(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketches = written(docs.mapInArrow(_sketched, "doc_id long, n long, s1 long, s2 long, bands array<long>"), "sketches")

    filled = sketches.filter("n > 0 AND doc_id IS NOT NULL")
    reps = written(filled.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "sets")
    placed = filled.select("doc_id", "n", "s1", "s2").join(reps.select("n", "s1", "s2", "rep"), ["n", "s1", "s2"])
    owner = written(placed.groupBy("doc_id").agg(F.min("rep").alias("rep"), F.collect_set("rep").alias("reps")), "owners")
    repeated = owner.filter("size(reps) > 1").select(F.explode("reps").alias("a"), F.col("rep").alias("b")).filter("a <> b")

    member = reps.select("rep", "n", F.explode("bands").alias("bucket"))
    hubs = written(member.groupBy("bucket").agg(F.min_by(F.struct("rep", "n"), "rep").alias("hub"), F.count("*").alias("c"))
                   .filter("c > 1").drop("c"), "hubs")
    shared = written(member.join(hubs, "bucket").select("bucket", "rep", "n", F.col("hub.rep").alias("hub"), F.col("hub.n").alias("hub_n")),
                     "buckets")
    sets = written(docs.join(shared.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
                   .mapInArrow(_packed, "id long, members binary"), "members")

    # each member against its smallest hub, then across components
    tested = written(shared.filter("rep <> hub").filter(_alike("n", "hub_n")).groupBy(F.col("rep").alias("a"))
                     .agg(F.min("hub").alias("b")), "pairs")
    links = repeated.unionByName(written(_confirm(tested.withColumns({"part": F.col("a"), "other": F.col("b")}), sets), "links"))
    parts = components(links).withColumnRenamed("node", "rep")
    at = shared.join(parts, "rep", "left").select("bucket", "rep", "n", F.coalesce("component", "rep").alias("part"))
    mixed = written(at.groupBy("bucket").agg(F.min("part").alias("p"), F.max("part").alias("q"), F.sum("n").alias("total")).filter("p <> q")
                    .select("bucket", F.ceil(F.col("total") / CELL).cast("int").alias("cells")), "mixed")
    own = F.pmod(F.xxhash64("rep"), F.col("cells")).cast("int")
    blocks = (at.join(mixed, "bucket").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
              .select("bucket", "rep", "part", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
              .join(sets.select(F.col("id").alias("rep"), "members"), "rep"))
    across = (blocks.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
              .select("bucket", "lo", "hi", "own", "part", "members").mapInArrow(_joined, "a long, b long"))
    parts = components(links.unionByName(written(across, "across")))
    found = (owner.join(parts, F.col("rep") == F.col("node"), "left")
             .select(F.col("doc_id").alias("id"), F.coalesce("component", "rep").alias("component")))
    return (sketches.select("doc_id", F.col("n").alias("n_shingles")).join(found, F.col("doc_id") == F.col("id"), "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id") == F.col("component_id")))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component, and
    every row without a doc_id."""
    gone = near_duplicates(docs).filter("NOT kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")
