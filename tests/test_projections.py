"""Edge rows for the projection operators (P07, P08) and rare grouping
(T09) against plain Python."""

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.functions.exprs import finite, int_label
from tessera.operators.features import RARE_CODE, apply_rare, fit_rare
from tessera.roles import Roles


def test_finite_turns_nan_and_inf_to_null(spark):
    vals = [1.5, float("nan"), float("inf"), float("-inf"), None, -0.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    got = {r["i"]: r["x"] for r in df.select("i", finite("x").alias("x")).collect()}
    want = {i: (None if v is None or math.isnan(v) or math.isinf(v) else v) for i, v in enumerate(vals)}
    assert got == want


def test_int_label_casts_text_and_rejects_junk(spark):
    df = spark.createDataFrame([("0",), ("1",), (" 1",)], "y string")
    assert [r["y"] for r in df.select(int_label("y").alias("y")).collect()] == [0, 1, 1]
    bad = spark.createDataFrame([("yes",)], "y string")
    with pytest.raises(PySparkException):
        bad.select(int_label("y")).collect()


def test_rare_counts_nulls_in_the_total(spark):
    # 10 rows: 'a' x5, 'b' x2, 'c' x1, NULL x2. Threshold 0.15 -> rare iff count <= 1.5 (of 10 rows)
    vals = ["a"] * 5 + ["b"] * 2 + ["c"] + [None] * 2
    df = spark.createDataFrame([(i, v, i % 2) for i, v in enumerate(vals)], "id int, k string, y int")
    rare = fit_rare(df, 0.15, Roles(), cols=["k"])
    assert rare == {"k": ["c"]}
    out = apply_rare(df, rare).orderBy("id").select("k").collect()
    assert [r["k"] for r in out] == ["a"] * 5 + ["b"] * 2 + [str(RARE_CODE)] + [None] * 2


def test_rare_skips_columns_with_many_values(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(0).alias("y"))
    assert fit_rare(df, 0.5, Roles(), max_unique=50, cols=["k"]) == {}


def test_clips_keep_null_and_nan(spark):
    from tessera.functions.exprs import clip, clip_upper
    vals = [None, float("nan"), -5.0, 0.5, 7.0, float("inf")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    got = df.select("i", clip("x", 0.0, 1.0).alias("c"), clip_upper("x", 1.0).alias("u")).orderBy("i").collect()

    def same(a, b):
        return (a is None and b is None) or (a is not None and b is not None and
                                            (a == b or (math.isnan(a) and math.isnan(b))))
    want_c = [None, float("nan"), 0.0, 0.5, 1.0, 1.0]
    want_u = [None, float("nan"), -5.0, 0.5, 1.0, 1.0]
    assert all(same(r["c"], w) for r, w in zip(got, want_c))
    assert all(same(r["u"], w) for r, w in zip(got, want_u))
