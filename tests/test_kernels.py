"""Exact kernels against brute force, including the bucketed path."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.functions import quantiles as Q
from tessera.operators import score as M


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 4000
    x = np.round(rng.lognormal(0, 2, n), 3)
    x[: n // 3] = 5.0                         # a hot value with a third of the rows
    z = rng.integers(0, 4, n).astype(float)
    z[::97] = np.nan
    y = (rng.random(n) < 1 / (1 + np.exp(-np.log(x)))).astype(int)
    pdf = pd.DataFrame({"x": x, "z": z, "y": y, "g": rng.integers(0, 3, n)})
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("rows_per_bucket", [Q.ROWS_PER_BUCKET, 50])
def test_quantiles_match_pandas(skewed, rows_per_bucket):
    pdf, df = skewed
    ps = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = Q.column_quantiles(df, ["x", "z"], ps, rows_per_bucket=rows_per_bucket)
    for c in ("x", "z"):
        want = pdf[c].quantile(ps).tolist()
        assert np.allclose(got[c], want, rtol=1e-12, atol=1e-12), (c, got[c], want)


def test_grouped_quantiles(skewed):
    pdf, df = skewed
    got = Q.quantiles(df, {"x": [0.5, 0.9]}, group_cols=["g"], rows_per_bucket=30)
    for g, part in pdf.groupby("g"):
        for p in (0.5, 0.9):
            assert abs(got[((g,), "x", p)] - part["x"].quantile(p)) < 1e-12


def _auc_brute(s, y):
    pos, neg = s[y == 1], s[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum()
    eq = (pos[:, None] == neg[None, :]).sum()
    return (gt + 0.5 * eq) / (len(pos) * len(neg))


@pytest.mark.parametrize("rows_per_bucket", [Q.ROWS_PER_BUCKET, 40])
def test_auc_matches_brute_force(skewed, rows_per_bucket, monkeypatch):
    pdf, df = skewed
    monkeypatch.setattr(Q, "ROWS_PER_BUCKET", rows_per_bucket)
    orig = Q.cumulative

    def small(*a, **k):
        k.setdefault("rows_per_bucket", rows_per_bucket)
        return orig(*a, **k)
    monkeypatch.setattr(M, "cumulative", small)
    got = M.roc_auc(df, "y", "x").first()["auc"]
    assert abs(got - _auc_brute(pdf["x"].values, pdf["y"].values)) < 1e-12


def test_univariate_auc_median_fill(skewed):
    pdf, df = skewed
    from tessera.roles import Roles
    r = {row["feature"]: row["auc"] for row in M.univariate_auc(df, Roles(key=None), ["z"]).collect()}
    z = pdf["z"].fillna(pdf["z"].median()).values
    assert abs(r["z"] - _auc_brute(z, pdf["y"].values)) < 1e-12


def test_single_class_omitted(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1)], "p double, y int")
    assert M.roc_auc(df, "y", "p").count() == 0


def test_modes_tie_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert Q.modes(df, ["c"]) == {"c": "a"}




def test_filled_order_stats_vs_brute_force(spark):
    """Median, quantiles of the median-filled column, quantiles of a clip of
    it, and the distinct count after the fill, against numpy on the filled
    values; columns: ties + NULLs, interpolated median + NULLs (fill adds a
    value), no NULLs, all NULL, NaN kept by the fill."""
    import random
    from tessera.functions.quantiles import filled_order_stats
    rnd = random.Random(3)
    data = {
        "a": [None if i % 4 == 0 else float(rnd.randint(0, 9)) for i in range(101)],
        "b": [None if i % 3 == 0 else float(i) for i in range(100)] + [None],   # even count -> interpolated
        "c": [rnd.gauss(0, 1) for _ in range(101)],
        "d": [None] * 101,
        "e": [float("nan") if i % 5 == 0 else (None if i % 7 == 0 else float(i % 13)) for i in range(101)],
    }
    cols = list(data)
    df = spark.createDataFrame(list(zip(*[data[c] for c in cols])), ", ".join(f"{c} double" for c in cols))
    ps = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]
    fs = filled_order_stats(df, cols, {c: ps for c in cols})
    for c in cols:
        v = np.array([x for x in data[c] if x is not None and not math.isnan(x)])
        if len(v) == 0:
            assert fs[c].median is None and fs[c].quantile(0.5) is None
            continue
        med = float(np.quantile(v, 0.5))
        assert fs[c].median == pytest.approx(med, abs=1e-12)
        nulls = sum(1 for x in data[c] if x is None or math.isnan(x))
        filled = np.concatenate([v, np.full(nulls, med)])
        for p in ps:
            assert fs[c].quantile(p) == pytest.approx(float(np.quantile(filled, p)), abs=1e-12), (c, p)
            lo, hi = float(np.quantile(filled, 0.3)), float(np.quantile(filled, 0.6))
            want = float(np.quantile(np.clip(filled, lo, hi), p))
            assert fs[c].quantile(p, lambda x: max(min(x, hi), lo)) == pytest.approx(want, abs=1e-12), (c, p)
        assert fs[c].nd_filled == len(set(filled.tolist())), c


def test_bracketed_ranks_are_exact_and_shuffle_little(spark):
    """Order statistics of normal, tied, constant, short and empty columns; rows behind the exchange."""
    from tessera.functions import quantiles as Q
    rng = np.random.default_rng(11)
    n = 120_000
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 7, n).astype(float), "c": np.ones(n), "d": np.full(n, np.nan),
                        "e": np.where(np.arange(n) < 3, rng.normal(size=n), np.nan), "f": np.exp(rng.normal(size=n) * 6)})
    from tessera.functions.exprs import finite_table
    df = finite_table(spark.createDataFrame(pdf).repartition(4))
    ps = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = Q.column_quantiles(df, list(pdf), ps)
    for c in pdf:
        want = [None] * len(ps) if pdf[c].isna().all() else pdf[c].quantile(ps).tolist()
        assert all(g == w or abs(g - w) <= 1e-12 * abs(w) for g, w in zip(got[c], want)), c
    raw = Q.column_quantiles(spark.createDataFrame([(float("nan"),), (3.0,), (None,), (1.0,)], "x double"), ["x"], [0.5, 1.0])
    assert raw["x"] == [2.0, 3.0]       # NaN is skipped
    counts, ranks = Q.bracketed(df, ["a", "f"], lambda c, m: {0, 17, m // 3, m - 2, m - 1})
    for c in ("a", "f"):
        v = np.sort(pdf[c].to_numpy())
        assert counts[c] == n and all(ranks[c, k] == v[k] for k in (0, 17, n // 3, n - 2, n - 1))
    # the median's bracket: what the exchange would carry
    held = []
    keep = type(df).persist
    try:
        type(df).persist = lambda self, *a: held.append(self) or keep(self, *a)
        Q.column_quantiles(df, ["a", "f"], [0.5])
    finally:
        type(df).persist = keep
    assert held[-1].count() < 0.01 * 2 * n


def test_a_missed_bracket_is_found_by_the_full_shuffle(spark, monkeypatch):
    from tessera.functions import quantiles as Q
    df = spark.createDataFrame([(float(i * i % 1009),) for i in range(1009)], "x double")
    right = Q.column_quantiles(df, ["x"], [0.1, 0.5])
    real = Q.F.percentile_approx
    monkeypatch.setattr(Q.F, "percentile_approx", lambda c, p, a: real(c, Q.F.array(*[Q.F.lit(i / Q.GRID / 5) for i in range(1, Q.GRID)]), a))
    assert Q.column_quantiles(df, ["x"], [0.1, 0.5]) == right
