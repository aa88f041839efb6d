"""The histogram booster: split gains against brute force, independence of partitions, missing values, best-first order."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import boost as B
from tessera.operators.score import roc_auc


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.normal(size=n), "b": rng.integers(0, 6, n).astype(float), "c": rng.uniform(size=n)})
    z = 1.5 * pdf.a * (pdf.b > 2) - pdf.c + rng.normal(0, 0.7, n)
    pdf["y"] = (z > 0.2).astype(int)
    pdf.loc[rng.random(n) < 0.15, "a"] = np.nan
    pdf["fold"] = pdf.id % 3 + 1
    return pdf


def brute_split(x, g, h, l2, leaf_rows, leaf_hessian):
    """Best gain of one feature over all thresholds and both sides for missing values."""
    gone, best = np.isnan(x), -np.inf
    score = lambda s: g[s].sum() ** 2 / (h[s].sum() + l2)
    for t in np.unique(x[~gone]):
        for missing_left in (True, False):
            left = np.where(gone, missing_left, x <= t)
            if min(left.sum(), (~left).sum()) >= leaf_rows and min(h[left].sum(), h[~left].sum()) >= leaf_hessian:
                best = max(best, score(left) + score(~left) - score(np.ones(len(x), bool)))
    return best


def test_best_split_matches_brute_force():
    rng = np.random.default_rng(1)
    for trial in range(30):
        x = rng.integers(0, 12, 200).astype(float)
        x[rng.random(200) < rng.choice([0, 0.3])] = np.nan
        g, h = rng.normal(size=200), rng.uniform(0.05, 0.25, 200)
        edges = [np.unique(x[~np.isnan(x)])[:-1]]
        b = B.binned(x[:, None], edges)[0].astype(int)
        bins = len(edges[0]) + 2
        hist = np.stack([np.bincount(b, v, bins) for v in (g, h, None)]).reshape(3, 1, bins)
        l2, least = float(rng.choice([0.0, 1.0, 3.0])), int(rng.choice([1, 20]))
        gain = B.best_splits(hist, l2, least, 0.5)[0][0]
        want = brute_split(x, g, h, l2, least, 0.5)
        assert gain == want or abs(gain - want) < 1e-9


def fitted(df, settings, **kw):
    return B.fit_boosted(df, ["a", "b", "c"], settings, fold="fold", holdout={1: 1, 2: 2, 9: None}, weight=2.0, **kw)


@pytest.mark.parametrize("settings", [B.Boost(rounds=6, rate=0.3, depth=4), B.Boost(rounds=4, rate=0.3, leaves=12, leaf_rows=20, l2=0.0, leaf_hessian=1e-3)])
def test_same_trees_from_any_partitions_and_both_paths(spark, rows, settings, monkeypatch):
    monkeypatch.setattr(B, "LEAST_BLOCK", 500)
    df = spark.createDataFrame(rows)
    whole = fitted(df, settings)
    many = fitted(df.repartition(7), settings, one_block=100)               # a job a level, sums met on the driver
    monkeypatch.setattr(B, "GATHER_BYTES", 0)
    met = fitted(df.orderBy(F.desc("id")), settings, one_block=100)         # and in a shuffle
    for m in whole:
        assert whole[m].node_rows() == many[m].node_rows() == met[m].node_rows()
        if settings.leaves:
            assert all(sum(f < 0 for f in t.feature) <= settings.leaves for t in whole[m].trees)
    assert whole[1].node_rows() != whole[2].node_rows()


def test_best_first_takes_the_largest_gains(spark, rows):
    """With few leaves, no unopened node has a larger gain than an opened one had."""
    m = B.fit_boosted(spark.createDataFrame(rows), ["a", "b", "c"], B.Boost(rounds=1, leaves=6, row_frac=1.0, col_frac=1.0))[0]
    full = B.fit_boosted(spark.createDataFrame(rows), ["a", "b", "c"], B.Boost(rounds=1, depth=8, row_frac=1.0, col_frac=1.0))[0]
    t, u = m.trees[0], full.trees[0]
    assert sum(f < 0 for f in t.feature) == 6
    # the same greedy order over the fully grown tree
    ready, gains = [0], []
    while len(gains) < 5:
        node = max(ready, key=lambda n: u.gain[n])
        ready.remove(node)
        gains.append(u.gain[node])
        ready += [u.left[node], u.right[node]]
    assert np.allclose(sorted(gains), sorted(g for g, f in zip(t.gain, t.feature) if f >= 0))


def test_learns_saves_and_reads_caps(spark, rows, tmp_path):
    df = spark.createDataFrame(rows)
    m = B.fit_boosted(df, ["a", "b", "c"], B.Boost(rounds=40, rate=0.2), caps={0: {"c": 0.5}}, columns={0: ["a", "c", "b"]})[0]
    assert all(not (f == 2 and m.edges[2][s] >= 0.5) for t in m.trees for f, s in zip(t.feature, t.split) if f >= 0 and s < len(m.edges[f]))
    auc = roc_auc(m.score(df, ["y"]), "y", "p").first()["auc"]
    assert auc > 0.85
    back = B.Boosted.load(spark, m.save(spark, f"{tmp_path}/m"))
    x = rows[["a", "b", "c"]].to_numpy()
    assert np.array_equal(back.margins(x), m.margins(x))
    p = {r["id"]: r["p"] for r in m.score(df, ["id"]).collect()}
    assert np.allclose([p[i] for i in rows.id], 1 / (1 + np.exp(-m.margins(x))))
    assert abs(sum(m.importance()) - 1) < 1e-9


def test_one_class_and_constant_columns(spark):
    df = spark.createDataFrame([(i, 1.0, None, i % 2 if i < 10 else 0) for i in range(40)], "id long, a double, b double, y int")
    m = B.fit_boosted(df, ["a", "b"], B.Boost(rounds=3))[0]
    assert all(len(t.feature) == 1 for t in m.trees)
    none = B.fit_boosted(df.where("y = 0"), ["a", "b"], B.Boost(rounds=2))[0]
    assert none.score(df, ["id"]).agg(F.max("p")).first()[0] < 1e-6


def test_siblings_are_differences_and_nothing_is_shipped_twice(spark, rows, monkeypatch):
    """Below the root no more than half of the drawn rows are added up, over more rounds than one broadcast holds."""
    added, real = [], B._histograms

    def counted(x, slot, *rest):
        added.append(len(slot))
        return real(x, slot, *rest)

    monkeypatch.setattr(B, "_histograms", counted)
    settings = B.Boost(rounds=1, depth=3, row_frac=1.0, col_frac=1.0)
    x = rows[["a", "b", "c"]].to_numpy()
    edges = [np.unique(c[~np.isnan(c)])[:200] for c in x.T]
    block = {"m": 0, "n": len(x), "wide": 1, "x": B.binned(x, edges).tobytes(), "y": rows.y.to_numpy(np.int8).tobytes(),
             "fold": rows.fold.to_numpy(np.int32).tobytes(), "hash": rows.id.to_numpy(np.int64).tobytes()}
    run = B._grown_in_task(settings, {0: [0, 1, 2]}, {0: 0.0}, {0: {}}, {0: None}, 2.0 ** 30, 1.0, B._missing(edges))
    import pyarrow as pa
    list(run([pa.RecordBatch.from_pylist([block])]))
    assert added[0] == len(x) and all(n <= len(x) // 2 for n in added[1:])
    monkeypatch.undo()
    monkeypatch.setattr(B, "LEAST_BLOCK", 500)
    df, s = spark.createDataFrame(rows), B.Boost(rounds=2 * B.SHIP + 3, rate=0.3, depth=2)
    assert fitted(df, s)[2].node_rows() == fitted(df, s, one_block=100)[2].node_rows()


def test_blocks_are_dealt_evenly_with_their_margins(spark, rows, tmp_path, monkeypatch):
    """Each task has as many blocks as any other; a block's margins go on from the round before and no checkpoint is left."""
    edges = [np.unique(c[~np.isnan(c)])[:200] for c in rows[["a", "b", "c"]].to_numpy().T]
    blocks = B._blocks(spark.createDataFrame(rows), ["a", "b", "c"], "id", "y", "fold", edges, 12)
    dealt = B._dealt(blocks, 3, 4)
    assert dealt.glom().map(len).collect() == [3, 3, 3, 3]
    missing, tree = B._missing(edges), (np.array([1, -1, -1]), np.array([2, 0, 0]), np.ones(3, bool), np.array([1, -1, -1]), np.array([2, -1, -1]), np.array([0.0, 1.0, 2.0]))
    twice = dealt.mapPartitions(B._started({7: 0.5})).mapPartitions(B._advanced({7: tree}, missing)).mapPartitions(B._advanced({7: tree}, missing))
    for _, x, y, _, _, margins in twice.collect():
        assert np.array_equal(margins[7], 0.5 + 2 * np.where(x[1] <= 2, 1.0, 2.0))
    blocks.unpersist()
    monkeypatch.setattr(B, "LEAST_BLOCK", 500)
    gone, real = [], B.delete_folder
    monkeypatch.setattr(B, "delete_folder", lambda s, path: gone.append((path, real(s, path))))
    fitted(spark.createDataFrame(rows), B.Boost(rounds=2 * B.SHIP + 1, rate=0.3, depth=2), one_block=100)
    assert len(gone) == 2 and all(path and done for path, done in gone)


def test_features_of_few_bins_are_added_up_together(monkeypatch):
    """Joint bins give each feature's own sums, with caps, missing values, some of the rows, and fewer passes than features."""
    rng = np.random.default_rng(4)
    n, missing = 5000, np.array([200, 5, 3, 60, 7, 250])
    x = np.stack([rng.integers(0, m + 1, n) for m in missing]).astype(np.uint8)
    g, h = np.rint(rng.normal(size=n) * 2 ** 20), np.rint(rng.uniform(size=n) * 2 ** 20)
    slot, features, caps, inside = rng.integers(0, 3, n), [0, 1, 2, 3, 5], {1: 2, 3: 40}, np.flatnonzero(rng.random(n) < 0.6)
    passes, real = [], np.bincount
    monkeypatch.setattr(B.np, "bincount", lambda *a: passes.append(1) or real(*a))
    for least in (1 << 20, 8, 0):       # none, some and all groups together
        monkeypatch.setattr(B, "JOINT_ROWS", least)
        for rows in (None, inside):
            at = np.arange(n) if rows is None else rows
            passes.clear()
            made = B._histograms(B._coded(x, features, caps, missing), slot[at], 3, g[at], h[at], rows)
            assert sorted(made) == features and len(passes) < 3 * len(features)
            for f in features:
                b = np.where(x[f] == missing[f], x[f], np.minimum(x[f], caps.get(f, 255))).astype(int)[at]
                want = [real(slot[at] * (missing[f] + 1) + b, v, 3 * (missing[f] + 1)).reshape(3, -1) for v in (g[at], h[at], None)]
                assert np.array_equal(made[f], np.stack(want))


def test_a_table_of_several_blocks_is_grown_in_tasks(spark, rows, monkeypatch):
    """Up to TASK_ROWS rows and TASK_CELLS cells no job a level is run; beyond, jobs give the same trees."""
    calls, real = [], B._grown_in_jobs
    monkeypatch.setattr(B, "_grown_in_jobs", lambda *a: calls.append(1) or real(*a))
    monkeypatch.setattr(B, "BLOCK_ROWS", 500)
    monkeypatch.setattr(B, "LEAST_BLOCK", 500)
    df, s = spark.createDataFrame(rows), B.Boost(rounds=3, rate=0.3, leaves=9, leaf_rows=5)
    whole = fitted(df, s)
    assert not calls
    monkeypatch.setattr(B, "TASK_CELLS", 8000)      # 3 columns: 2,666 of 3,000 rows
    beyond = fitted(df, s)
    assert calls and all(whole[m].node_rows() == beyond[m].node_rows() for m in whole)
