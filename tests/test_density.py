"""Binned density curves against the exact ones, and given k-means centres
against brute force."""

import numpy as np
import pandas as pd
import pytest

from tessera.operators import model as ML
from tessera.operators import profile as P


def curves(df):
    return df.toPandas().sort_values([c for c in ("y", "column_name", "point") if c in df.columns], ignore_index=True)


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(5)
    n = 3000
    pdf = pd.DataFrame({"a": rng.normal(40, 9, n), "b": np.exp(rng.normal(0, 2, n)), "c": rng.integers(0, 5, n).astype(float),
                        "flat": 3.0, "y": rng.integers(0, 2, n)})
    pdf.loc[::7, "a"] = np.nan
    pdf.loc[5, "b"] = np.inf
    return spark.createDataFrame(pdf)


@pytest.mark.parametrize("by", [None, "y"])
def test_binned_curves_are_the_exact_ones(skewed, by):
    exact, binned = (curves(f(skewed, ["a", "b", "c", "flat"], by=by)) for f in (P.density, P.density_binned))
    assert list(exact.columns) == list(binned.columns) and len(exact) == len(binned) > 0
    assert (exact[["column_name", "point"]] == binned[["column_name", "point"]]).all().all()
    assert np.allclose(exact["x"], binned["x"], rtol=1e-12)
    top = exact.groupby("column_name")["density"].transform("max")
    assert (np.abs(exact["density"] - binned["density"]) <= 1e-6 * top).all()


def test_binned_curves_have_mass_one_and_do_not_depend_on_partitions(skewed):
    one, many = (curves(P.density_binned(skewed.repartition(n), ["a", "c"])) for n in (1, 7))
    assert np.allclose(one["density"], many["density"], rtol=1e-9)
    for _, g in one.groupby("column_name"):
        assert abs(np.trapezoid(g["density"], g["x"]) - 1) < 0.01


def test_no_curve_without_two_values(spark):
    df = spark.createDataFrame([(1.0, None, 0), (1.0, 2.0, 1), (None, None, None)], "p double, q double, y int")
    assert P.density_binned(df, ["p", "q"]).count() == 0
    assert P.density_binned(df.limit(0), ["p"], by="y").count() == 0


def test_a_null_class_has_its_own_curve(spark):
    df = spark.createDataFrame([(float(i), None if i % 2 else 1) for i in range(20)], "v double, y int")
    got = P.density_binned(df, ["v"], by="y").groupBy("y").count().collect()
    assert sorted((str(r["y"]), r["count"]) for r in got) == [("1", P.KDE_POINTS), ("None", P.KDE_POINTS)]


def test_rows_go_to_the_nearest_given_centre(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 2)).round(3)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)] + [(300, None, 0.0)], "id int, a double, b double")
    centres = [[0.5, 0.0], [-0.5, 0.0], [0.5, 0.0]]
    got = {r["id"]: r for r in ML.kmeans_assign(df, 3, ["a", "b"], keep=("id",), centres=centres).collect()}
    want = np.argmin(((x[:, None] - np.array(centres)) ** 2).sum(2), axis=1)
    assert [got[i]["cluster"] for i in range(300)] == want.tolist() and 2 not in want
    assert got[300]["a"] is None and got[300]["cluster"] == int(np.median(x[:, 0]) < 0)
    with pytest.raises(ValueError):
        ML.kmeans_assign(df, 2, ["a", "b"], centres=centres)
