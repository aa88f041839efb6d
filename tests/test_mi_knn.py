"""Nearest-neighbour mutual information against brute force over all pairs."""

import math

import numpy as np
import pandas as pd
import pytest

from tessera.operators import score as M
from tessera.roles import Roles


def psi(m):
    return -M.EULER + sum(1.0 / i for i in range(1, int(m)))


def brute(x, y, k):
    keep = np.array([(y == c).sum() > 1 for c in y])
    x, y = x[keep], y[keep]
    total = 0.0
    for i in range(len(x)):
        same = np.sort(np.abs(x[(y == y[i])] - x[i]))[1:]
        need = min(k, len(same))
        r = same[need - 1]
        m = (x == x[i]).sum() if r == 0 else (np.abs(x - x[i]) <= r * (1 - 1e-9)).sum()
        total += psi(need) - psi((y == y[i]).sum()) - psi(m)
    return max(0.0, psi(len(x)) + total / len(x))


@pytest.mark.parametrize("rows_per_range", [5, 40, 1_000_000])
def test_matches_brute_force(spark, rows_per_range):
    rng = np.random.default_rng(8)
    n = 300
    y = rng.integers(0, 3, n)
    y[0] = 7                                        # a class of one
    y[1:4] = 8                                      # a class of three
    pdf = pd.DataFrame({"id": np.arange(n), "y": y, "cont": rng.normal(size=n) + y, "ties": rng.integers(0, 5, n) + (y == 1) * 2.0,
                        "grid": rng.integers(0, 60, n) / 10.0, "const": np.ones(n), "holes": np.where(rng.random(n) < 0.3, np.nan, rng.normal(size=n))})
    cols = ["cont", "ties", "grid", "const", "holes"]
    got = {r["feature"]: r["mi"] for r in M.mutual_information_knn(spark.createDataFrame(pdf), Roles(), cols, 3, rows_per_range).collect()}
    for c in cols:
        x = pdf[c].fillna(pdf[c].median()).to_numpy(float)
        assert math.isclose(got[c], brute(x, y, 3), abs_tol=1e-9), c


def test_no_rows_and_digamma(spark):
    assert M.mutual_information_knn(spark.createDataFrame([], "id long, a double, y int"), Roles(), ["a"]).collect() == []
    rows = spark.range(1, 60).select("id", M.digamma("id").alias("p")).collect()
    assert all(abs(r["p"] - psi(r["id"])) < 1e-10 for r in rows)
