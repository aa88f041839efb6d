"""Second-order boosted trees on histograms.

Features are cut once into at most ``bins`` ranges between exact quantiles and kept as bytes, a
block of up to BLOCK_ROWS rows a table row. A table of at most TASK_ROWS rows (and TASK_CELLS cells) is one block, and each
model's rounds are one task over it; else growing a level of trees is one short job over the cached blocks: every task adds up
gradients, hessians and rows per (node, feature, bin) over its blocks, the sums meet by
(model, feature), and the best split of each node comes back. Of two siblings only the one with fewer rows is
added up; the other is the difference to their parent. Features of few bins are added up together, by their joint bin, and their
own sums are taken from that. All models of
a cross-validation grow in the same jobs: a row counts for the models whose fold it is not in.

A node's value is -G / (H + l2), a split's gain GL^2/(HL + l2) + GR^2/(HR + l2) - G^2/(H + l2).
Missing values have a bin of their own and go to the side that gains more. Trees grow by
level to ``depth`` or, with ``leaves``, best first: a wave evaluates the children of all nodes that
best-first order would open, until that order meets no unknown node.

The fit doesn't depend on row order, partitions or retries: rows are sampled by a
hash of their key, quantiles are exact, and gradients are rounded to integers whose sums
are exact in any order. The margins are a column of the blocks: each round makes, from the cached blocks of the
round before, new ones with its trees added, so no task catches up on old trees, and every SHIP rounds they are checkpointed.

Moved a level: tasks x nodes x bins sums, added up by the driver while they are within GATHER_BYTES, else in a
shuffle by (model, feature). Rows move twice, into blocks and to the tasks that share these evenly. The driver holds
trees and split candidates."""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, functions as F

from tessera.functions.exprs import finite_table
from tessera.functions.quantiles import column_quantiles
from tessera.session import checkpoint_dir, delete_folder, materialize

BLOCK_ROWS, LEAST_BLOCK = 1 << 17, 4096
TASK_ROWS, TASK_CELLS = 1 << 20, 1 << 24    # up to so many rows and cells (bytes) a model's rounds are one task
JOINT_BINS, JOINT_ROWS = 1 << 11, 8         # features are added up together up to so many joint bins, and up to one for so many rows
GATHER_BYTES = 64 << 20     # of a job's sums that the driver adds up itself; more meet in a shuffle
SHIP = 10                   # rounds between two checkpoints of the blocks with their margins


@dataclass(frozen=True)
class Boost:
    """Settings of a fit."""
    rounds: int = 600
    depth: int = 6
    leaves: int | None = None       # best first to so many; depth then bounds nothing
    rate: float = 0.03
    row_frac: float = 0.8
    col_frac: float = 0.8
    bins: int = 254
    l2: float = 1.0
    leaf_rows: int = 1
    leaf_hessian: float = 1.0
    seed: int = 42


@dataclass
class Tree:
    """Arrays by node; feature < 0 at a leaf. Rows with bin <= split go left."""
    feature: list = field(default_factory=lambda: [-1])
    split: list = field(default_factory=lambda: [0])
    missing_left: list = field(default_factory=lambda: [True])
    left: list = field(default_factory=lambda: [-1])
    right: list = field(default_factory=lambda: [-1])
    value: list = field(default_factory=lambda: [0.0])
    rows: list = field(default_factory=lambda: [0.0])
    gain: list = field(default_factory=lambda: [0.0])
    depth: list = field(default_factory=lambda: [0])

    def arrays(self) -> tuple:
        return (np.array(self.feature, np.int32), np.array(self.split, np.int32), np.array(self.missing_left, bool),
                np.array(self.left, np.int32), np.array(self.right, np.int32), np.array(self.value))


def _place(tree: tuple, x: np.ndarray, missing: np.ndarray, at: np.ndarray | None = None, rows: np.ndarray | None = None) -> np.ndarray:
    """The leaf of each row (of the given ``rows``) of a (features, rows) array of bins, on from the nodes ``at``."""
    feature, split, missing_left, left, right, _ = tree
    n, x = x.shape[1], np.ascontiguousarray(x).reshape(-1)
    rows = np.arange(n) if rows is None else rows
    at = np.zeros(len(rows), np.intp) if at is None else at.astype(np.intp)
    inner = feature >= 0
    f, bins = np.where(inner, feature, 0), np.arange(int(missing.max()) + 1)
    child = np.where(np.where(bins == missing[f][:, None], missing_left[:, None], bins <= split[:, None]), left[:, None], right[:, None])
    child = np.where(inner[:, None], child, np.arange(len(inner))[:, None]).reshape(-1)     # a leaf leads to itself
    first = f.astype(np.intp) * n       # of the node's feature

    def below(at, rows):
        while going := np.count_nonzero(open_ := inner.take(at)):
            if 2 * going < len(at):     # most rows are in their leaves
                some = np.flatnonzero(open_)
                at[some] = below(at.take(some), rows.take(some))
                break
            cell = first.take(at)
            cell += rows
            step = at * len(bins)
            step += x.take(cell)
            at = child.take(step)
        return at

    return below(at, rows)


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """(features, rows) bins of a (rows, features) array; a missing value has the bin after the last."""
    out = np.empty(x.shape[::-1], np.uint8 if max(map(len, edges), default=0) < 254 else np.uint16)
    for f, e in enumerate(edges):
        col = x[:, f]
        out[f] = np.where(np.isfinite(col), np.searchsorted(e, col, side="left"), len(e) + 1)
    return out


def _missing(edges: list[np.ndarray]) -> np.ndarray:
    return np.array([len(e) + 1 for e in edges], np.int64)


class Boosted:
    """A fitted model: margin = base + the leaf values of all trees."""

    def __init__(self, cols: list[str], edges: list[np.ndarray], base: float, trees: list[Tree]):
        self.cols, self.edges, self.base, self.trees = list(cols), edges, base, trees

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Margins of a (rows, features) array, missing values as NaN."""
        b, missing = binned(x, self.edges), _missing(self.edges)
        out = np.full(len(x), self.base)
        for t in self._compiled():
            out += t[5][_place(t, b, missing)]
        return out

    def _compiled(self) -> list[tuple]:
        if not hasattr(self, "_arrays"):
            self._arrays = [t.arrays() for t in self.trees]
        return self._arrays

    def score(self, df: DataFrame, keep: list[str], out: str = "p") -> DataFrame:
        """``keep`` and the probability of label 1, for every row."""
        model, n = df.sparkSession.sparkContext.broadcast(self), len(keep)
        rows = finite_table(df.select(*keep, *[F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate(self.cols)]))
        schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:n]] + [f"`{out}` double"])

        def run(batches):
            for batch in batches:
                x = np.stack([batch.column(n + i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(model.value.cols))], axis=1)
                p = 1.0 / (1.0 + np.exp(-model.value.margins(x)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(p)], [*keep, out])

        return rows.mapInArrow(run, schema)

    def importance(self) -> list[float]:
        """Each feature's share of all split gains."""
        total = np.zeros(len(self.cols))
        for t in self.trees:
            for f, g in zip(t.feature, t.gain):
                if f >= 0:
                    total[f] += g
        return (total / total.sum() if total.sum() > 0 else total).tolist()

    def node_rows(self) -> list[tuple]:
        """The saved form: a row per node."""
        return [(k, j, t.feature[j], float(self.edges[t.feature[j]][t.split[j]]) if 0 <= t.feature[j] and t.split[j] < len(self.edges[t.feature[j]]) else None,
                 t.split[j], bool(t.missing_left[j]), t.left[j], t.right[j], float(t.value[j]), float(t.rows[j]), float(t.gain[j]), t.depth[j])
                for k, t in enumerate(self.trees) for j in range(len(t.feature))]

    def save(self, spark, path: str) -> str:
        nodes = spark.createDataFrame(self.node_rows(), "tree int, node int, feature int, threshold double, split int, missing_left boolean, "
                                                        "left int, right int, value double, rows double, gain double, depth int")
        nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        head = spark.createDataFrame([(i, c, [float(v) for v in e], self.base) for i, (c, e) in enumerate(zip(self.cols, self.edges))],
                                     "position int, column_name string, edges array<double>, base double")
        head.write.mode("overwrite").parquet(f"{path}/features")
        return path

    @classmethod
    def load(cls, spark, path: str) -> Boosted:
        head = spark.read.parquet(f"{path}/features").orderBy("position").collect()
        trees: list[Tree] = []
        for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():
            if r["node"] == 0:
                trees.append(Tree([], [], [], [], [], [], [], [], []))
            t = trees[-1]
            for name in ("feature", "split", "missing_left", "left", "right", "value", "rows", "gain", "depth"):
                getattr(t, name).append(r[name])
        return cls([r["column_name"] for r in head], [np.array(r["edges"]) for r in head], head[0]["base"], trees)


# ---------------------------------------------------------------- blocks

def _blocks(df: DataFrame, cols: list[str], key: str, label: str, fold: str | None, edges: list[np.ndarray], count: int) -> DataFrame:
    """(block, n, x, y, fold, hash): bins, labels, folds and key hashes of up to about BLOCK_ROWS rows, in key order."""
    rows = df.select(F.xxhash64(key).alias("hash"), F.col(key).cast("string").alias("key"), F.col(label).cast("int").alias("y"),
                     (F.col(fold).cast("int") if fold else F.lit(0)).alias("fold"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    rows = rows.withColumn("block", F.pmod("hash", F.lit(count)).cast("int"))

    def pack(t: pa.Table) -> pa.Table:
        h = t["hash"].to_numpy()
        x = np.stack([t[f"x{i}"].to_numpy().astype(float) for i in range(len(cols))], axis=1)
        order = np.argsort(h, kind="stable")        # a row's place follows from its key
        if (np.diff(h[order]) == 0).any():
            order = np.lexsort((np.array(t["key"].to_pylist(), object).astype(str), h))
        b = binned(x[order], edges)
        return pa.table({"block": [t["block"][0].as_py()], "n": [len(h)], "wide": [b.dtype.itemsize], "x": [b.tobytes()],
                         "y": [t["y"].to_numpy()[order].astype(np.int8).tobytes()],
                         "fold": [t["fold"].to_numpy()[order].astype(np.int32).tobytes()], "hash": [h[order].tobytes()]},
                        schema=pa.schema([("block", pa.int32()), ("n", pa.int32()), ("wide", pa.int32()), ("x", pa.binary()), ("y", pa.binary()),
                                          ("fold", pa.binary()), ("hash", pa.binary())]))

    packed = rows.repartition(count, "block").groupBy("block").applyInArrow(
        pack, "block int, n int, wide int, x binary, y binary, fold binary, hash binary")
    return materialize(packed, "boost-blocks").persist(StorageLevel.MEMORY_AND_DISK)


# ---------------------------------------------------------------- in tasks

def _started(bases: dict):
    """Blocks with every model's first margins."""

    def run(blocks):
        for _, (block, x, y, fold, key) in blocks:
            yield block, x, y, fold, key, {m: np.full(len(y), base) for m, base in bases.items()}

    return run


def _advanced(trees: dict, missing: np.ndarray):
    """Blocks with the trees of one round added to the margins."""

    def run(blocks):
        for *block, x, y, fold, key, margins in blocks:
            yield *block, x, y, fold, key, {m: margin + trees[m][5][_place(trees[m], x, missing)] for m, margin in margins.items()}

    return run


def _spread(x: np.ndarray) -> np.ndarray:
    """A mix of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _opened(r: dict, features: int) -> tuple:
    """x, y, folds and key hashes of a block's row."""
    return (np.frombuffer(r["x"], np.uint8 if r["wide"] == 1 else np.uint16).reshape(features, r["n"]), np.frombuffer(r["y"], np.int8),
            np.frombuffer(r["fold"], np.int32), np.frombuffer(r["hash"], np.int64).view(np.uint64))


def _drawn(settings: Boost, round_no: int, h: np.ndarray) -> np.ndarray:
    """The round's rows, by their key's hash."""
    if settings.row_frac >= 1:
        return np.ones(len(h), bool)
    return _spread(h ^ np.uint64(_seeded(settings.seed, round_no))) < np.uint64(int(settings.row_frac * 2 ** 64))


def _gradients(margin: np.ndarray, y: np.ndarray, weight: float, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and hessians of the logistic loss as integers."""
    p = 1.0 / (1.0 + np.exp(-margin))
    w = np.where(y == 1, weight, 1.0)
    return np.rint(w * (p - y) * scale), np.rint(w * p * (1 - p) * scale)


def _coded(x: np.ndarray, features: list[int], caps: dict[int, int], missing: np.ndarray, rows: np.ndarray | None = None) -> list[tuple]:
    """(features, their numbers of bins, joint bins of the rows) of groups of features with few bins."""
    out: list = []
    for f in sorted(features, key=lambda f: (missing[f], f)):
        bins, b = int(missing[f]) + 1, x[f] if rows is None else x[f].take(rows)
        if f in caps:       # values above a cap are the cap
            b = np.where(b == missing[f], b, np.minimum(b, caps[f]))
        if out and math.prod(out[-1][1]) * bins <= JOINT_BINS:
            group, widths, code = out[-1]
            out[-1] = ([*group, f], [*widths, bins], code.astype(np.uint16) * np.uint16(bins) + b)
        else:
            out.append(([f], [bins], b))
    return out


def _histograms(coded: list[tuple], slot: np.ndarray, width: int, g: np.ndarray, h: np.ndarray, rows: np.ndarray | None = None) -> dict[int, np.ndarray]:
    """Per feature (g, h, rows) x slots x bins; of the given rows, whose slots and gradients these are."""
    out, todo = {}, list(coded)
    while todo:
        group, widths, code = todo.pop(0)
        code = code if rows is None else code.take(rows)
        while todo and math.prod(widths) * math.prod(todo[0][1]) * width * JOINT_ROWS <= len(slot):     # few nodes: more features together
            more, wide, other = todo.pop(0)
            code = code.astype(np.int32) * math.prod(wide)
            code += other if rows is None else other.take(rows)
            group, widths = [*group, *more], [*widths, *wide]
        cells = math.prod(widths)
        at = slot * cells + code if width > 1 else code.astype(np.intp)
        made = np.stack([np.bincount(at, v, width * cells) for v in (g, h, None)]).reshape(3, width, *widths)
        for i, f in enumerate(group):
            out[f] = made.sum(axis=tuple(2 + j for j in range(len(group)) if j != i)) if len(group) > 1 else made
    return out


def _sums(growing: dict, slots: dict, features: dict, caps: dict, holdout: dict, scale: float, weight: float, settings: Boost, round_no: int,
          missing: np.ndarray):
    """Each model's and feature's histograms over a task's blocks, as ((model, feature), sums)."""

    def run(blocks):
        total: dict = {}
        for _, x, y, fold, key, margins in blocks:
            drawn = _drawn(settings, round_no, key)
            for m in growing:
                used = np.flatnonzero(drawn if holdout[m] is None else drawn & (fold != holdout[m]))
                slot = slots[m].take(_place(growing[m], x, missing, rows=used))
                inside = np.flatnonzero(slot >= 0)
                used = used.take(inside)
                g, h = _gradients(margins[m].take(used), y.take(used), weight, scale)
                for f, made in _histograms(_coded(x, features[m], caps[m], missing, used), slot.take(inside), int(slots[m].max()) + 1, g, h).items():
                    total[m, f] = made if (m, f) not in total else total[m, f] + made
        return total.items()

    return run


def _seeded(seed: int, round_no: int) -> int:
    return int(_spread(np.array([seed * 1_000_003 + round_no + 1], np.uint64))[0])


def best_splits(hist: np.ndarray, l2: float, leaf_rows: int, leaf_hessian: float) -> list[tuple]:
    """For (3, slots, bins) sums of one feature, the last bin the missing values: per
    slot (gain, bin, missing_left, gl, hl, nl, g, h, n), gain -inf without a split."""
    g, h, n = hist
    whole = hist.sum(axis=2)
    known = np.cumsum(hist[:, :, :-1], axis=2)
    sides = []
    for missing_left in (True, False) if hist[2, :, -1].any() else (True,):
        left = known + hist[:, :, -1:] if missing_left else known
        right = whole[:, :, None] - left
        ok = (left[2] >= leaf_rows) & (right[2] >= leaf_rows) & (left[1] >= leaf_hessian) & (right[1] >= leaf_hessian)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left[0] ** 2 / (left[1] + l2) + right[0] ** 2 / (right[1] + l2) - (whole[0] ** 2 / (whole[1] + l2))[:, None]
        sides.append((np.where(ok & np.isfinite(gain), gain, -np.inf), left))
    both = np.stack([s[0] for s in sides], axis=2)      # slots, bins, sides: first the smallest bin, then missing left
    both = both.reshape(len(both), -1)
    slot, k = np.arange(len(both)), both.argmax(axis=1)
    b, side = np.divmod(k, len(sides))
    left = np.where(side == 0, sides[0][1][:, slot, b], sides[-1][1][:, slot, b])
    return list(zip(both[slot, k].tolist(), b.tolist(), (side == 0).tolist(), *left.tolist(), *whole.tolist()))


def _chosen(slots: list[tuple[int, int]], f: int, hist: np.ndarray, settings: Boost, scale: float) -> list[tuple]:
    """The best split by feature f of each slot, a slot being a (model, place)."""
    hist = hist.copy()
    hist[:2] /= scale
    return [(m, s, f, *best) for (m, s), best in zip(slots, best_splits(hist, settings.l2, settings.leaf_rows, settings.leaf_hessian))]


# ---------------------------------------------------------------- growing

class _Growing:
    """One model's tree while it grows: the splits that are known."""

    def __init__(self, settings: Boost):
        self.s, self.tree = settings, Tree()
        self.known: dict[int, tuple] = {}           # node: (gain, feature, bin, missing_left, left sums, sums)
        self.sums: dict[int, tuple] = {}
        self.family: dict[int, tuple[int, int]] = {}    # node: (parent, sibling)
        self.open: set[int] = set()                 # nodes with children in the arrays
        self.moved: dict[int, int] | None = None    # node: its number in the finished tree, where that has others

    def _split(self, node: int) -> None:
        """Give a node its children; whether the tree keeps them is settled in finish()."""
        if node in self.open:
            return
        gain, f, b, missing_left, left, whole = self.known[node]
        t = self.tree
        t.feature[node], t.split[node], t.missing_left[node], t.gain[node] = f, b, missing_left, gain
        for sums in (left, tuple(a - c for a, c in zip(whole, left))):
            child = len(t.feature)
            for name, v in (("feature", -1), ("split", 0), ("missing_left", True), ("left", -1), ("right", -1),
                            ("value", 0.0), ("rows", sums[2]), ("gain", 0.0), ("depth", t.depth[node] + 1)):
                getattr(t, name).append(v)
            self.sums[child] = sums
        a, b = t.left[node], t.right[node] = len(t.feature) - 2, len(t.feature) - 1
        self.family[a], self.family[b] = (node, b), (node, a)
        self.open.add(node)

    def _worth(self, node: int) -> bool:
        return node in self.known and self.known[node][0] > 0

    def wanted(self) -> list[int]:
        """Nodes to evaluate in the next job; none when the tree is known."""
        if 0 not in self.known:
            return [0]
        if self.s.leaves is None:
            fresh = [n for n in sorted(self.known) if n not in self.open and self._worth(n) and self.tree.depth[n] < self.s.depth]
            for n in fresh:
                self._split(n)
            if not fresh:
                return []
            return [c for n in fresh for c in (self.tree.left[n], self.tree.right[n]) if self.tree.depth[c] < self.s.depth]
        return self._best_first()[1]

    def _best_first(self) -> tuple[list[int], list[int]]:
        """(nodes to split, in order; children that are not evaluated but might matter)."""
        ready, chosen, unknown = [0], [], []
        while len(chosen) + 1 < self.s.leaves:
            ready = [n for n in ready if self._worth(n)]
            if not ready:
                break
            node = min(ready, key=lambda n: (-self.known[n][0], n))
            ready.remove(node)
            self._split(node)
            chosen.append(node)
            for child in (self.tree.left[node], self.tree.right[node]):
                if child in self.known:
                    ready.append(child)
                elif len(chosen) + 1 < self.s.leaves:
                    unknown.append(child)
        return chosen, unknown

    def learn(self, node: int, best: tuple | None) -> None:
        """A node's best split, as (feature, gain, bin, missing_left, left sums, sums); None where no row was drawn."""
        if best is None:
            self.sums.setdefault(node, (0.0, 0.0, 0.0))
            self.known[node] = (-math.inf, -1, 0, True, (0.0, 0.0, 0.0), self.sums[node])
            return
        f, gain, b, missing_left, *sums = best
        self.sums[node] = tuple(sums[3:])
        self.tree.rows[node] = sums[5]
        self.known[node] = (gain, f, b, missing_left, tuple(sums[:3]), self.sums[node])

    def finish(self) -> Tree:
        """The tree with leaf values, without nodes that best-first order didn't open."""
        t, s = self.tree, self.s
        kept = set(self._best_first()[0]) if s.leaves is not None else self.open
        for n in range(len(t.feature)):
            if n not in kept:
                g, h, _ = self.sums[n]
                t.feature[n], t.left[n], t.right[n], t.gain[n] = -1, -1, -1, 0.0
                t.value[n] = -g / (h + s.l2) * s.rate if h + s.l2 > 0 else 0.0
        if len(kept) == len(self.open):
            return t
        self.moved = {}
        order, out = [0], Tree([], [], [], [], [], [], [], [], [])
        for n in order:     # breadth first over what is kept
            if t.feature[n] >= 0:
                order += [t.left[n], t.right[n]]
        new = {n: k for k, n in enumerate(order)}
        for n in range(len(t.feature)):     # a node that went is in the leaf above it
            self.moved[n] = new[n] if n in new else self.moved[self.family[n][0]]
        for n in order:
            for name in ("feature", "split", "missing_left", "value", "rows", "gain", "depth"):
                getattr(out, name).append(getattr(t, name)[n])
            for name in ("left", "right"):
                getattr(out, name).append(new.get(getattr(t, name)[n], -1))
        return out


def _columns_of_round(settings: Boost, features: list[int], round_no: int, model: int) -> list[int]:
    take = max(1, round(settings.col_frac * len(features)))
    return sorted(np.random.default_rng([settings.seed, round_no, model]).choice(features, take, replace=False).tolist())


def _asked(nodes: list[int], growing: _Growing, known: dict[int, np.ndarray]) -> list[int]:
    """The nodes whose sums are to be made: of two siblings with a known parent the one with fewer rows."""
    def other_does(node):
        parent, sibling = growing.family.get(node, (-1, -1))
        rows = lambda n: (growing.sums[n][2], n)
        return parent in known and (sibling in known or (sibling in wanted and rows(sibling) < rows(node)))

    wanted = set(nodes)
    return [n for n in nodes if not other_does(n)]


def _grow(settings: Boost, round_no: int, features: dict[int, list[int]], scale: float, missing: np.ndarray, add_up, meet=None) -> dict[int, Tree]:
    """One tree of every model. ``add_up(asked, growing, drawn)`` gives the sums of the asked nodes by (model, feature), or
    None where they are too many for one place; then ``meet(wanted, growing, drawn)`` gives the
    split candidates (as _chosen does) of the wanted nodes."""
    drawn = {m: _columns_of_round(settings, fs, round_no, m) for m, fs in features.items()}
    growing = {m: _Growing(settings) for m in features}
    known: dict[int, dict[int, np.ndarray]] = {m: {} for m in features}     # node: (3, all bins of the drawn features)
    while wanted := {m: w for m in features if (w := growing[m].wanted())}:
        asked = {m: a for m, w in wanted.items() if (a := _asked(w, growing[m], known[m]))}
        made = add_up(asked, growing, drawn)
        rows = meet(wanted, growing, drawn) if made is None else []
        met: dict = {}      # feature: the slots and sums of all models that may split by it
        for m, nodes in wanted.items() if made is not None else ():
            whole = [made[m, f] for f in drawn[m] if (m, f) in made]
            if whole:
                whole = np.concatenate(whole, axis=2)
                known[m].update((n, whole[:, s]) for s, n in enumerate(asked[m]))
            for n in nodes:
                if n not in known[m]:
                    parent, sibling = growing[m].family.get(n, (-1, -1))
                    if parent in known[m] and sibling in known[m]:
                        known[m][n] = known[m][parent] - known[m][sibling]
            if all(n in known[m] for n in nodes):
                hist, start = np.stack([known[m][n] for n in nodes], axis=1), 0
                for f in drawn[m]:
                    slots, parts = met.setdefault(f, ([], []))
                    slots += [(m, s) for s in range(len(nodes))]
                    parts.append(hist[:, :, start:start + int(missing[f]) + 1])
                    start += int(missing[f]) + 1
        for f, (slots, parts) in met.items():
            rows += _chosen(slots, f, np.concatenate(parts, axis=1), settings, scale)
        best: dict = {}
        for m, slot, f, *rest in rows:
            if (m, slot) not in best or (-rest[0], f) < (-best[m, slot][1], best[m, slot][0]):
                best[m, slot] = (f, *rest)
        for m, nodes in wanted.items():
            for slot, node in enumerate(nodes):
                growing[m].learn(node, best.get((m, slot)))
    return {m: t.finish() for m, t in growing.items()}


def _slots(nodes: list[int], tree: Tree) -> np.ndarray:
    out = np.full(len(tree.feature), -1, np.int64)
    out[nodes] = np.arange(len(nodes))
    return out


def _grown_in_task(settings: Boost, features: dict, bases: dict, caps: dict, holdout: dict, scale: float, weight: float, missing: np.ndarray):
    """All rounds of the models that a task gets, over a table of one block: (model, tree, pickled arrays)."""

    def fit_one(m: int, r: dict) -> list[Tree]:
        x, y, fold, key = _opened(r, len(missing))
        if holdout[m] is not None:
            mine = np.flatnonzero(fold != holdout[m])
            x, y, key = np.take(x, mine, axis=1), y.take(mine), key.take(mine)
        trees: list[Tree] = []
        margin = np.full(len(y), bases[m])
        for k in range(settings.rounds):
            taken = _drawn(settings, k, key)
            used, rest = np.flatnonzero(taken), np.flatnonzero(~taken)
            part, at, coded, grown = np.take(x, used, axis=1) if len(rest) else x, None, None, None
            g, h = _gradients(margin.take(used), y.take(used), weight, scale)

            def add_up(asked, growing, drawn):
                nonlocal at, coded, grown
                if m not in asked:
                    return {}
                grown = growing[m]
                coded = _coded(part, drawn[m], caps[m], missing) if coded is None else coded
                at = _place(grown.tree.arrays(), part, missing, at)
                if len(grown.tree.feature) == 1:    # the root
                    made = _histograms(coded, at, 1, g, h)
                else:
                    slot = _slots(asked[m], grown.tree).take(at)
                    inside = np.flatnonzero(slot >= 0)
                    made = _histograms(coded, slot.take(inside), len(asked[m]), g.take(inside), h.take(inside), inside)
                return {(m, f): hist for f, hist in made.items()}

            tree = _grow(settings, k, {m: features[m]}, scale, missing, add_up)[m]
            trees.append(tree)
            compiled = tree.arrays()
            if grown.moved:
                at = np.array([grown.moved[n] for n in range(len(grown.moved))], np.intp).take(at)
            margin[used] += compiled[5].take(_place(compiled, part, missing, at))       # on from the nodes where they are
            margin[rest] += compiled[5].take(_place(compiled, x, missing, rows=rest))
        return trees

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([r["m"]], pa.int32()), pa.array([pickle.dumps(fit_one(r["m"], r))], pa.binary())], ["m", "trees"])

    return run


def fit_boosted(df: DataFrame, cols: list[str], settings: Boost, label: str = "y", key: str = "id", fold: str | None = None,
                holdout: dict[int, int | None] | None = None, weight: float = 1.0, columns: dict[int, list[str]] | None = None,
                caps: dict[int, dict[str, float]] | None = None, one_block: int | None = None) -> dict[int, Boosted]:
    """A model for each key of ``holdout``, fitted on the rows outside of its fold (None: on all rows, the default).

    ``weight`` is that of label 1. A model may have its own ``columns`` and ``caps`` (values above one are read as the
    cap). Rows with a null label take no part. A table of at most ``one_block`` rows (by default TASK_ROWS, fewer if it has more
    than TASK_CELLS cells) is one block, and each model's
    rounds are one task over it; a larger one is many blocks, and each level of all models' trees a job. Both
    give the same trees."""
    spark = df.sparkSession
    cols, holdout = list(cols), holdout or {0: None}
    df = finite_table(df.select(key, label, *([fold] if fold else []), *cols)).where(F.col(label).isNotNull())
    counted = df.groupBy(*([fold] if fold else [])).agg(F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("p")).collect()
    n = sum(r["n"] for r in counted)
    if not n:
        raise ValueError("no rows to fit")
    ps = [i / settings.bins for i in range(1, settings.bins)]
    found = column_quantiles(df, cols, ps)
    edges = [np.unique(np.array([v for v in found[c] if v is not None], float)) for c in cols]
    missing = _missing(edges)
    scale = 2.0 ** min(30, int(52 - math.log2(max(n, 2) * max(weight, 1.0))))     # sums of rounded gradients stay exact
    bases, features, tops = {}, {}, {}
    for m, out in holdout.items():
        rows = [r for r in counted if out is None or r[fold] != out]
        pos = sum(r["p"] or 0 for r in rows) * weight
        neg = sum(r["n"] - (r["p"] or 0) for r in rows)
        bases[m] = math.log(pos / neg) if pos > 0 and neg > 0 else (20.0 if pos > 0 else -20.0)
        features[m] = [cols.index(c) for c in ((columns or {}).get(m) or cols)]
        tops[m] = {cols.index(c): int(np.searchsorted(edges[cols.index(c)], v, side="left")) for c, v in ((caps or {}).get(m) or {}).items() if c in cols}
    cores = spark.sparkContext.defaultParallelism
    if one_block is None:
        one_block = min(TASK_ROWS, max(BLOCK_ROWS, TASK_CELLS // max(len(cols), 1)))
    count = 1 if n <= one_block else min(-(-n // (BLOCK_ROWS * cores)) * cores, -(-n // LEAST_BLOCK))   # as many for each core
    blocks = _blocks(df, cols, key, label, fold, edges, count)
    try:
        if count == 1:
            dealt = (blocks.withColumn("m", F.explode(F.lit(list(holdout)).cast("array<int>")))
                     .repartitionByRange(len(holdout), "m") if len(holdout) > 1 else blocks.withColumn("m", F.lit(next(iter(holdout))).cast("int")))
            grown = dealt.mapInArrow(_grown_in_task(settings, features, bases, tops, holdout, scale, weight, missing), "m int, trees binary").collect()
            trees = {r["m"]: pickle.loads(r["trees"]) for r in grown}
        else:
            trees = _grown_in_jobs(blocks, count, settings, features, bases, tops, holdout, scale, weight, missing)
    finally:
        blocks.unpersist()
    return {m: Boosted(cols, edges, bases[m], trees[m]) for m in holdout}


def _dealt(blocks: DataFrame, features: int, tasks: int) -> RDD:
    """(number, (block, x, y, fold, hash)) as arrays; each task has as many blocks as any other, or one less."""
    return (blocks.select("block", "n", "wide", "x", "y", "fold", "hash").rdd.map(lambda r: (r["block"], (r["block"], *_opened(r, features))))
            .partitionBy(tasks, lambda b: b))


def _grown_in_jobs(blocks: DataFrame, count: int, settings: Boost, features: dict, bases: dict, caps: dict, holdout: dict, scale: float, weight: float,
                   missing: np.ndarray) -> dict[int, list[Tree]]:
    """Every level of all models' trees is one job over the blocks, kept as arrays with their margins: a task a core, whose
    sums of all its blocks are one answer."""
    spark = blocks.sparkSession
    sc = spark.sparkContext
    trees: dict[int, list[Tree]] = {m: [] for m in holdout}
    tasks = min(count, sc.defaultParallelism)
    parts = max(1, min(sum(map(len, features.values())), sc.defaultParallelism))
    checkpoint_dir(spark)
    now, before, saved = _dealt(blocks, len(missing), tasks).mapPartitions(_started(bases)).persist(StorageLevel.MEMORY_AND_DISK), None, []
    try:
        for k in range(settings.rounds):
            if k:
                before, now = now, now.mapPartitions(_advanced({m: t[-1].arrays() for m, t in trees.items()}, missing)).persist(StorageLevel.MEMORY_AND_DISK)
                if k % SHIP == 0:       # ends the chain of rounds behind a block
                    now.checkpoint()

            def sums(nodes, growing, drawn):
                return now.mapPartitions(_sums(
                    {m: growing[m].tree.arrays() for m in nodes}, {m: _slots(w, growing[m].tree) for m, w in nodes.items()}, {m: drawn[m] for m in nodes},
                    caps, holdout, scale, weight, settings, k, missing))

            def add_up(asked, growing, drawn):
                if tasks * sum(24 * len(w) * sum(int(missing[f]) + 1 for f in drawn[m]) for m, w in asked.items()) > GATHER_BYTES:
                    return None
                total: dict = {}
                for at, made in sums(asked, growing, drawn).collect() if asked else ():
                    total[at] = made if at not in total else total[at] + made
                return total

            def meet(wanted, growing, drawn):
                return (sums(wanted, growing, drawn).reduceByKey(lambda a, b: a + b, parts)
                        .flatMap(lambda r: _chosen([(r[0][0], s) for s in range(r[1].shape[1])], r[0][1], r[1], settings, scale)).collect())

            for m, tree in _grow(settings, k, features, scale, missing, add_up, meet).items():
                trees[m].append(tree)
            if before is not None:      # the round's first job has read it
                before.unpersist()
            if k and k % SHIP == 0:
                saved.append(now.getCheckpointFile())
                for old in saved[:-1]:
                    delete_folder(spark, old)
                saved = saved[-1:]
    finally:
        for held in (before, now):
            if held is not None:
                held.unpersist()
        for old in saved:
            delete_folder(spark, old)
    return trees
