"""The model queries build and run on the smallest tables (boosted ones at a few rounds); the others that
have no SQL oracle are in the tests of their operators."""

from dataclasses import replace

import pytest

from tessera.operators import model as ML
from tessera.plans.registry import QUERIES, load_all

load_all()
SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def few_rounds(monkeypatch):
    monkeypatch.setattr(ML, "boost_settings", lambda p, full=ML.boost_settings: replace(full(p), rounds=3))


MODELS = ["l01_cv_boosted_a", "l02_cv_boosted_b", "e07_test_mean_prediction", "e11_corr_threshold_sweep", "e12_shap_k_sweep",
          "m05_shap_importance", "f04_select_by_model", "s11_model_round_trip"]


def test_every_query_is_callable_and_named_once():
    assert all(callable(f) for f in QUERIES.values()) and set(MODELS) <= set(QUERIES)


@pytest.mark.parametrize("name", MODELS)
def test_query_runs(spark, name):
    df = QUERIES[name](spark, SF)
    assert len(set(df.columns)) == len(df.columns)
    df.write.format("noop").mode("overwrite").save()
