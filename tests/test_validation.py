"""The reference's validation tests, re-expressed on Spark."""

import pandas as pd

from tessera.operators import profile as P
from tessera.roles import Roles


def _checks(df):
    return {(r["check"], r["column_name"]): r["value"] for r in P.validation_table(df, Roles(key=None)).collect()}


def test_clean_table(sample_df):
    c = _checks(sample_df)
    assert c[("total_missing", None)] == 0
    assert c[("duplicates", None)] == 0
    assert {k[1] for k in c if k[0] == "target_distribution"} == {"0", "1"}
    assert not [k for k in c if k[0] == "missing_values"]


def test_injected_nulls(spark, sample_pdf):
    pdf = sample_pdf.copy().astype({"age": "float64"})
    pdf.loc[0, "age"] = None
    pdf.loc[1, "balance"] = None
    c = _checks(spark.createDataFrame(pdf))
    assert c[("total_missing", None)] == 2
    assert c[("missing_values", "age")] == 1 and c[("missing_values", "balance")] == 1
    m = {r["column_name"]: r["missing_count"] for r in P.missing_counts(spark.createDataFrame(pdf)).collect()}
    assert m == {"age": 1, "balance": 1}


def test_duplicate_row(spark, sample_pdf):
    pdf = pd.concat([sample_pdf, sample_pdf.iloc[[0]]], ignore_index=True)
    assert P.duplicate_rows(spark.createDataFrame(pdf)).first()["duplicate_rows"] == 1


def test_outliers(spark, sample_pdf):
    pdf = sample_pdf.copy()
    pdf.loc[0, "balance"] = 1_000_000.0
    pdf.loc[1, "age"] = 150
    o = {r["column_name"]: r["outlier_count"] for r in
         P.iqr_outlier_counts(spark.createDataFrame(pdf), Roles(key=None)).collect()}
    assert o["balance"] > 0 and o["age"] > 0
    assert "y" not in o


def test_outlier_bounds_match_pandas(sample_pdf, sample_df):
    b = P.iqr_bounds(sample_df, ["balance", "age"])
    for c in ("balance", "age"):
        q1, q3 = sample_pdf[c].quantile(0.25), sample_pdf[c].quantile(0.75)
        assert abs(b[c][0] - (q1 - 1.5 * (q3 - q1))) < 1e-9
        assert abs(b[c][1] - (q3 + 1.5 * (q3 - q1))) < 1e-9


def test_class_distribution(sample_pdf, sample_df):
    got = {r["y"]: (r["n"], r["pct"]) for r in P.class_distribution(sample_df).collect()}
    vc = sample_pdf["y"].value_counts()
    for k, n in vc.items():
        assert got[k][0] == n and abs(got[k][1] - n / len(sample_pdf)) < 1e-12


def test_empty_table(spark, sample_df):
    empty = sample_df.limit(0)
    assert P.duplicate_rows(empty).first()["duplicate_rows"] == 0
    assert P.missing_counts(empty).count() == 0
