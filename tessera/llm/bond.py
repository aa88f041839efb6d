"""Hard negatives by a vertical scan with branch and bound (BOND).

Rows are dealt by a hash of their row number to groups of bounded size. A task holds one
group at a time as a vertical block: one contiguous array per dimension, sorted
by label, with each dimension's least and greatest value. Anchors are dealt to every
group and stream past its block. Each anchor reads the dimensions in descending order of
its own magnitudes, a few at a time: the read ones make a candidate's partial score, and
the least and greatest contributions of the others bound what is still to come. After each
step the candidate set shrinks to the rows that the bounds cannot rule out, and
what is left at the last dimension has its exact score.

Two scans: the first finds each anchor's positives (best rows of its label), the second,
whose windows follow from the positives' scores, the best rows of other labels
in each window. Each group gives at most ``positives`` rows an anchor and
``negatives`` rows a window; the best of all groups are chosen by a window over those.

Scores are integers. Arrays are float32 or float64 where every partial sum is exact in
them (the largest magnitude and the vector length decide), int64 otherwise.

Moved: each row twice, each anchor once a group and scan; groups grow to GROUP_BYTES, so
their number, and with it the copies of an anchor, is the table's size by that bound. Every
anchor against every row is the stated task, so the work grows with the square of the table.

Defined cases: rows with a null id, label or vector or any null or non-finite component
take no part (a row without an id cannot be named); vectors are compared only
with vectors of their own length, an empty vector scores 0; rows that repeat an id are rows of
their own, each anchor leaves out only itself; other columns are not read, whatever
their names; an empty table gives an empty result; a table in which a score might not
fit in 62 bits is an error."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.llm.common import written

GROUP_BYTES = 128 << 20     # of a block
LEAST_ROWS = 4096           # of a group, while fewer groups than tasks would do
STEP = 8                    # dimensions between two looks at the bounds

_WINDOWS = "array<struct<p:int,pid:long,ps:long>>"      # rank, id and score of an anchor's positives
_FOUND = "anchor_rid long, anchor_id long, p int, pid long, ps long, rid long, id long, score long"
_SCHEMA = pa.schema([(f.split()[0], pa.int32() if f.split()[1] == "int" else pa.int64()) for f in _FOUND.split(", ")])


def usable(rows: DataFrame, id_col: str, label: Column, vector: str, scale: int) -> DataFrame:
    """(id, label, vector): rows that take part, components as floor(scale * x)."""
    x = F.col(vector).cast("array<double>")
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), x.alias("x"))
            .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & good)
            .select("id", "label", F.transform("x", lambda v: F.floor(v * F.lit(float(scale)))).alias("vector")))


class _Block:
    """One group, dimension by dimension, sorted by label."""

    def __init__(self, parts: list[tuple], kind):
        self.rid, self.id, label = (np.concatenate([p[k] for p in parts]) for k in range(3))
        self.m = np.concatenate([p[3] for p in parts], axis=1).astype(kind, copy=False)
        starts = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]]))
        self.slices = {int(label[a]): (int(a), int(b)) for a, b in zip(starts, [*starts[1:], len(label)])}
        bounds = lambda a, b: (self.m[:, a:b].min(axis=1), self.m[:, a:b].max(axis=1))
        self.bounds = {k: bounds(a, b) for k, (a, b) in self.slices.items()}
        self.all_bounds = bounds(0, len(label))

    def scan(self, q: np.ndarray, at: np.ndarray, first: slice, bounds, keep: Callable) -> tuple[np.ndarray, np.ndarray]:
        """(row, exact score) of the rows of ``first`` (of them ``at``, where given)
        that survive. ``keep(low, high)`` marks those whose bounds don't rule them out."""
        order = np.argsort(-np.abs(q), kind="stable")
        low, high = q * bounds[0], q * bounds[1]
        low, high = np.minimum(low, high)[order], np.maximum(low, high)[order]
        # contributions of the dimensions that are still to be read
        rest = lambda x: np.concatenate([np.cumsum(x[::-1])[::-1], np.zeros(1, x.dtype)])
        low, high = rest(low), rest(high)
        partial, whole = None, at is None
        for k in range(0, len(order), STEP):
            dims = order[k:k + STEP]
            columns = self.m[dims, first] if whole else self.m[np.ix_(dims, at)]
            made = q[dims] @ columns
            partial = made if partial is None else partial + made
            end = min(k + STEP, len(order))
            alive = keep(partial + low[end], partial + high[end])
            if end == len(order) or 2 * np.count_nonzero(alive) < len(partial):
                chosen = np.flatnonzero(alive)
                at, whole = (chosen + (first.start or 0) if whole else at[chosen]), False
                partial = partial[chosen]
                if not len(at):
                    break
        if partial is None:     # vectors without components
            at = np.arange(first.start, first.stop) if whole else at
            partial = np.zeros(len(at), self.m.dtype)
            chosen = np.flatnonzero(keep(partial, partial))
            at, partial = at[chosen], partial[chosen]
        return at, partial.astype(np.int64)


def _kth(values: np.ndarray, k: int):
    """The k-th largest value; None of fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else None


def _best(block: _Block, at: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """The first k by score, then by id, then by row number."""
    return np.lexsort((block.rid[at], block.id[at], -score))[:k]


def _positives(block: _Block, rid: int, label: int, q: np.ndarray, windows, k: int) -> Iterator[tuple]:
    if label not in block.slices:
        return
    first = slice(*block.slices[label])

    def keep(low, high):
        least = _kth(low, k + 1)    # one more: the anchor itself may be among them
        return np.ones(len(low), bool) if least is None else high >= least

    at, score = block.scan(q, None, first, block.bounds[label], keep)
    others = block.rid[at] != rid
    at, score = at[others], score[others]
    for j in _best(block, at, score, k).tolist():
        yield None, None, None, int(block.rid[at[j]]), int(block.id[at[j]]), int(score[j])


def _negatives(block: _Block, rid: int, label: int, q: np.ndarray, windows, k: int, low: tuple[int, int], high: tuple[int, int]) -> Iterator[tuple]:
    # low[0] * positive <= low[1] * negative and high[1] * negative <= high[0] * positive
    spans = [(-(-low[0] * w["ps"] // low[1]), high[0] * w["ps"] // high[1], w) for w in windows or ()]
    spans = [s for s in spans if s[0] <= s[1]]
    if not spans:
        return
    n = len(block.rid)
    a, b = block.slices.get(label, (0, 0))
    at = None if a == b else np.concatenate([np.arange(a), np.arange(b, n)])

    def keep(least, most):
        alive = np.zeros(len(least), bool)
        for lo, hi, _ in spans:
            may = (most >= lo) & (least <= hi)
            bound = _kth(least[(least >= lo) & (most <= hi)], k)
            alive |= may if bound is None else may & (most >= bound)
        return alive

    at, score = block.scan(q, at, slice(0, n), block.all_bounds, keep)
    for lo, hi, w in spans:
        inside = np.flatnonzero((score >= lo) & (score <= hi))
        for j in inside[_best(block, at[inside], score[inside], k)].tolist():
            yield w["p"], w["pid"], w["ps"], int(block.rid[at[j]]), int(block.id[at[j]]), int(score[j])


def _scanned(find: Callable, kind: str) -> Callable:
    """Blocks first, then the anchors of the same group, one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, parts, block, out = None, [], None, []
        for batch in batches:
            d, g, what = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("d", "g", "kind"))
            cuts = np.flatnonzero((d[1:] != d[:-1]) | (g[1:] != g[:-1]) | (what[1:] != what[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if a == b:
                    continue
                if group != (d[a], g[a]):
                    group, parts, block = (d[a], g[a]), [], None
                part = batch.slice(a, b - a)
                rid, ident, label = (part.column(k).to_numpy(zero_copy_only=False) for k in ("rid", "id", "label"))
                vectors = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(b - a, int(d[a])).astype(kind)
                if what[a] == 0:
                    parts.append((rid, ident, label, np.ascontiguousarray(vectors.T)))
                    continue
                if block is None and parts:
                    block, parts = _Block(parts, kind), []
                if block is None:
                    continue
                windows = part.column("windows").to_pylist()
                for k in range(b - a):
                    for found in find(block, int(rid[k]), int(label[k]), vectors[k], windows[k]):
                        out.append((int(rid[k]), int(ident[k]), *found))
                    if len(out) > 50_000:
                        yield _batch(out)
                        out = []
        if out:
            yield _batch(out)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SCHEMA.types)], schema=_SCHEMA)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3,
                   low: tuple[int, int] = (50, 100), high: tuple[int, int] = (95, 100), group_bytes: int = GROUP_BYTES) -> DataFrame:
    """For each anchor among (id, label, vector of integers) and each of its
    ``positives`` best rows of its label, the ``negatives`` best rows of other labels with
    low[0] * positive_score <= low[1] * negative_score and
    high[1] * negative_score <= high[0] * positive_score. Returns
    anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score."""
    spark = rows.sparkSession
    size = F.array_max(F.transform("vector", lambda v: F.abs(v)))
    # written before the row numbers are used: a repeated task would number anew
    rows = written(rows.select("id", "label", "vector", F.size("vector").alias("d"), is_anchor.alias("anchor"),
                               F.monotonically_increasing_id().alias("rid")), "vectors")
    n, most, d = rows.agg(F.count("*"), F.max(size), F.max("d")).first()
    top = (most or 0) ** 2 * max(d or 0, 1)
    if top >= 2 ** 62:
        raise ValueError("components too large: a score might not fit in 62 bits")
    kind = "float32" if top < 2 ** 24 else "float64" if top < 2 ** 53 else "int64"
    stored = "int" if (most or 0) < 2 ** 31 else "long"
    per_group = max(1, group_bytes // (np.dtype(kind).itemsize * max(d or 0, 1)))
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(-(-n // per_group), min(wide, -(-n // LEAST_ROWS)), 1)
    columns = ["rid", "id", "label", F.col("vector").cast(f"array<{stored}>").alias("vector")]
    dealt = rows.select("d", F.pmod(F.xxhash64("rid"), F.lit(groups)).cast("int").alias("g"), F.lit(0).alias("kind"), *columns,
                        F.lit(None).cast(_WINDOWS).alias("windows"))

    def scan(anchors: DataFrame, find: Callable) -> DataFrame:
        every = anchors.select("d", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.lit(1).alias("kind"), *columns, "windows")
        return (dealt.unionByName(every).repartition(4 * groups, "d", "g").sortWithinPartitions("d", "g", "kind", "label", "rid")
                .mapInArrow(_scanned(find, kind), _FOUND))

    def first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "rid")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    anchors = rows.filter("anchor")
    near = first(scan(anchors.withColumn("windows", F.lit(None).cast(_WINDOWS)),
                      lambda block, rid, label, q, w: _positives(block, rid, label, q, w, positives)), ["anchor_rid"], positives)
    windows = near.groupBy(F.col("anchor_rid").alias("rid")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("rank").alias("p"), F.col("id").alias("pid"), F.col("score").alias("ps")))).alias("windows"))
    windows = written(anchors.join(windows, "rid"), "windows")
    far = scan(windows, lambda block, rid, label, q, w: _negatives(block, rid, label, q, w, negatives, low, high))
    return first(far, ["anchor_rid", "p"], negatives).select(
        "anchor_id", F.col("pid").alias("positive_id"), F.col("p").alias("positive_rank"), "rank", F.col("id").alias("negative_id"),
        F.col("ps").alias("positive_score"), F.col("score").alias("negative_score"))
