"""Boundary rows and rules: missing values, keys, tokens, folders, folds."""

import os
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.exprs import finite_table
from tessera.operators import clean as C
from tessera.operators import combine as J
from tessera.operators import infold as IN
from tessera.operators import model as ML
from tessera.operators import profile as P
from tessera.operators import split as S
from tessera.roles import Roles
from tessera.session import checkpoint_dir
from tessera.sources import io as IO


def _tmp(spark, name):
    return os.path.join(checkpoint_dir(spark), "tests", uuid.uuid4().hex, name)


NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def dirty(spark):
    rows = [(float(i), float(i % 7), i) for i in range(40)] + [(NAN, 1.0, 40), (INF, 2.0, 41), (-INF, NAN, 42), (None, 3.0, 43)]
    return spark.createDataFrame(rows, "a double, b double, k int")


def test_missing_rule_everywhere(dirty):
    assert {r["column_name"]: r["missing_count"] for r in P.missing_counts(dirty).collect()} == {"a": 4, "b": 1}
    assert {r["column_name"]: r["outlier_count"] for r in P.iqr_outlier_counts(dirty, Roles(key="k", label=None)).collect()} == {"a": 0, "b": 0}
    d = {r["column_name"]: r for r in P.describe(dirty, Roles(key=None, label=None)).collect()}
    assert d["a"]["count"] == 40 and d["a"]["max"] == 39.0 and abs(d["a"]["mean"] - 19.5) < 1e-12
    assert sum(r["count"] for r in P.histogram(dirty, ["a"]).collect()) == 40
    filled = C.apply_median(dirty, C.fit_median(dirty, ["a"]))
    assert filled.where("a IS NULL OR isnan(a)").count() == 0
    scaled = C.apply_standard(dirty, C.fit_standard(dirty, ["a"]))
    assert scaled.where("a IS NOT NULL AND NOT isnan(a)").count() == 40
    r = P.correlation_pairs(dirty, ["a", "b"], upper_only=True, include_diagonal=False).first()["corr"]
    x = np.array([(i, i % 7) for i in range(40)], float)
    assert abs(r - np.corrcoef(x.T)[0, 1]) < 1e-12
    assert finite_table(dirty, ["b"]).where("isnan(a)").count() == 1


def test_pair_blocks(dirty, monkeypatch):
    wide = dirty.select("a", "b", "k", (F.col("a") * 2 + F.col("b")).alias("c"))
    whole = sorted(map(tuple, P.correlation_pairs(wide, ["a", "b", "c", "k"]).collect()))
    monkeypatch.setattr(P, "PAIR_BLOCK", 3)
    assert sorted(map(tuple, P.correlation_pairs(wide, ["a", "b", "c", "k"]).collect())) == whole


def test_pair_moments_are_those_of_complete_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(float(i) + 1e8, None if i % 3 == 0 else float(rng.normal()), 0.1, None if i % 2 else i % 5, None) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d int, e double").repartition(7)
    got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in P.correlation_pairs(df, list("abcde"), upper_only=True).collect()}
    x = np.array([[np.nan if v is None else v for v in r] for r in rows], float)
    assert len(got) == 15
    for i, a in enumerate("abcde"):
        for j, b in enumerate("abcde"[i:], i):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if both.any() and np.ptp(x[both, i]) and np.ptp(x[both, j]):
                assert abs(got[a, b] - np.corrcoef(x[both, i], x[both, j])[0, 1]) < 1e-9
            else:
                assert got[a, b] is None
    plan = P.correlation_pairs(df, list("abcd"), include_diagonal=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "covar_pop" not in plan


def test_submission_refuses_duplicate_predictions(spark):
    sample = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    preds = spark.createDataFrame([(1, 0.1), (2, 0.2), (2, 0.3), (3, 0.4)], "id long, y double")
    with pytest.raises(ValueError, match="several"):
        J.submission(sample, preds)
    assert J.submission(sample, preds.where("y <> 0.3")).count() == 3


def test_csv_missing_tokens(spark):
    path = _tmp(spark, "t.csv")
    spark.createDataFrame([("id,n,x,t",), ("1,5,1.5,a",), ("2,NA,nan,None",), ("3,7,inf,b",), ("4,,N/A,",)], "value string").coalesce(1).write.text(path)
    want = [(1, 5, 1.5, "a"), (2, None, None, None), (3, 7, None, "b"), (4, None, None, None)]
    df = IO.read_csv(spark, path)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["int", "int", "double", "string"]
    assert sorted(map(tuple, df.collect())) == want
    typed = IO.read_csv(spark, path, schema="id bigint, n double, x double, t string")
    assert sorted(map(tuple, typed.collect())) == [(a, None if b is None else float(b), c, d) for a, b, c, d in want]
    with pytest.raises(Exception):
        IO.read_csv(spark, path, schema="id bigint, n double, x double, t bigint").collect()


def test_external_folder_by_uri(spark):
    folder = _tmp(spark, "ext")
    IO.write_csv(spark.range(3), os.path.join(folder, "a.csv"))
    IO.write_csv(spark.range(2), os.path.join(folder, "b.CSV"))
    for f in (folder, "file://" + folder.removeprefix("file://")):
        assert [(n, df.count()) for n, df in IO.scan_external_csvs(spark, f)] == [("a.csv", 3), ("b.CSV", 2)]
    assert IO.scan_external_csvs(spark, folder + "/none") == []


def test_state_rebuilt_with_any_dictionary(spark):
    rows = [(i, float(i % 13) if i % 5 else None, f"v{i % 97}" if i % 11 else None, i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, x double, c string, y int")
    st = C.fit_clean(df, Roles(), cap_pct=0.9, cap_cols=("x",))
    path = _tmp(spark, "params")
    IO.save_params(C.params_frame(spark, st), path)
    params = IO.load_params(spark, path)
    assert params.where("operator = 'encode_ordinal'").count() == 97
    back = C.clean_state(params)
    a, b = (sorted(map(tuple, C.apply_clean(df, s).collect())) for s in (st, back))
    assert a == b


def test_shared_folder_is_required_off_local(spark, monkeypatch):
    from tessera import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return self

        def get(self, *_):
            return None

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


@pytest.fixture(scope="module")
def folded(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(500):
        y = int(rng.random() < 0.3)
        rows.append((i, float(rng.normal(y, 1)), float(rng.exponential(100)), float(rng.integers(1, 9)), float(y) * 10 + 1, y))
    df = spark.createDataFrame(rows, "id long, a double, duration double, campaign double, leak double, y int")
    return S.stratified_kfold(df.withColumn("twin", F.col("a") * 3), 5)


def test_one_cap_per_fold(folded):
    steps = IN.InFold(cap_q=0.9)
    copies, caps = IN.training_copies(folded, steps, 5)
    pdf = folded.toPandas()
    got = copies.groupBy("fit_fold").agg(F.max("duration").alias("m")).collect()
    for r in got:
        cap = pdf[pdf.fold != r["fit_fold"]].duration.quantile(0.9)
        assert abs(caps[(r["fit_fold"], "duration")] - cap) < 1e-9 and abs(r["m"] - cap) < 1e-9
    assert len({round(r["m"], 9) for r in got}) == 5 and copies.where("fold = fit_fold").count() == 0


def test_caps_and_capped_auc_without_copies(spark):
    """One shuffle against quantiles and AUC on copied, capped training rows, with ties and missing cells."""
    from tessera.operators import features as FE
    from tessera.operators import score as M
    rng = np.random.default_rng(12)
    rows = [(i % 5 + 1, int(rng.random() < 0.4), None if i % 7 == 0 else float(rng.integers(0, 30)),
             None if rng.random() < 0.2 else float(rng.exponential()), float(i % 3)) for i in range(600)]
    df = spark.createDataFrame(rows, "fold int, y int, a double, b double, c double")
    for q in (0.35, 0.9):
        caps = M.fold_caps(df, ["a", "b"], q, 5)
        copies = S.fold_training_copies(df, 5)
        want = FE.fit_cap_by_group(copies, ["a", "b"], q, "fit_fold")
        assert caps.keys() == want.keys() and all(abs(caps[k] - want[k]) < 1e-12 for k in caps)
        two = {(r["fit_fold"], r["feature"]): r["auc"] for r in M.univariate_auc(
            FE.apply_cap_by_group(copies, want, "fit_fold").drop("fold"), Roles(), ["a", "b", "c"], by=["fit_fold"]).collect()}
        one = {(r["fit_fold"], r["feature"]): r["auc"] for r in M.fold_auc(df, Roles(), ["a", "b", "c"], 5, caps=caps).collect()}
        assert set(one) == set(two) and all(abs(one[k] - two[k]) < 1e-12 for k in one)


def test_variance_and_model_steps_in_folds(spark, folded):
    df = folded.withColumn("flat", F.col("a") * 0.01).withColumn("text", F.lit("x"))
    cols = ["a", "duration", "campaign", "leak", "flat", "text"]
    steps = IN.InFold(cap_q=0.9, drop_leakers=True, var_threshold=0.01, model_k=2, model_rounds=5, model_depth=3)
    out = IN.fit_in_folds(df, cols, steps, Roles(), 5)
    pdf = df.toPandas()
    for f in range(1, 6):
        part = pdf[pdf.fold != f]
        want = [c for c in ("a", "duration", "campaign", "flat") if part[c].clip(upper=part[c].quantile(0.9) if c in ("duration", "campaign") else None).var() > 0.01]
        stages = [s for s in out.stages if s[0] == f]
        assert [s[1:3] for s in stages] == [("reduction", "var"), ("selection", "model")]
        assert stages[0][4] == want + ["text"] and "flat" not in want
        assert len(out.columns[f]) == 3 and out.columns[f][0] == "a" and out.columns[f][-1] == "text"
    by_quantile = IN.fit_in_folds(df, cols[:3], IN.InFold(importance_quantile=0.5, model_rounds=3, model_depth=2), Roles(), 5)
    assert all("a" in by_quantile.columns[f] and len(by_quantile.columns[f]) == 2 for f in range(1, 6))


def test_cross_validation_with_steps(spark, folded):
    steps = IN.InFold(cap_q=0.9, drop_leakers=True, corr_threshold=0.99, feature_list=("a", "duration", "campaign", "twin"), mi_k=2)
    path = _tmp(spark, "models")
    cols = ["a", "duration", "campaign", "leak", "twin"]
    test = folded.drop("fold", "y").limit(50)
    cv = ML.cross_validate(folded, cols, ML.LOGISTIC, test, Roles(), 5, steps=steps, model_dir=path)
    for f in range(1, 6):
        kept = cv.steps.columns[f]
        assert "leak" not in kept and "a" not in kept and "twin" in kept and len(kept) == 2
    assert cv.steps.log(spark).where("stage = 'selection'").count() == 10
    # every key once, scored by the model of its own fold's held-out part
    oof = cv.oof.toPandas()
    assert sorted(oof.id) == list(range(500))
    from pyspark.ml.classification import LogisticRegressionModel
    back = IO.load_model(LogisticRegressionModel, f"{path}/fold_2")
    part = C.apply_cap(folded.where("fold = 2"), cv.steps.caps[2])
    p = ML._Fitted(back).score(ML.assemble(part, cv.steps.columns[2]), ["id"]).toPandas().set_index("id").p
    assert np.allclose(oof[oof.fold == 2].set_index("id").p.sort_index(), p.sort_index())
    # The mean of the folds' scores
    means = cv.test.toPandas().set_index("id").p.sort_index()
    each = [m.score(ML.assemble(C.apply_cap(test, cv.steps.caps[f]), cv.steps.columns[f]), ["id"]).toPandas().set_index("id").p
            for f, m in enumerate(cv.models, 1)]
    assert np.allclose(means, sum(e.sort_index() for e in each) / 5)
    # Per-fold AUC is E01 of that fold's rows
    from tessera.operators.score import roc_auc
    metrics = {r["fold"]: r["roc_auc"] for r in cv.metrics.collect()}
    for f in range(1, 6):
        assert abs(metrics[f] - roc_auc(cv.oof.where(F.col("fold") == f), "y", "p").first()["auc"]) < 1e-12
    assert abs(metrics[0] - roc_auc(cv.oof, "y", "p").first()["auc"]) < 1e-12
    cv.release()


def test_baselines_report_errors_and_order(folded):
    bad = ML.Profile("broken", "no_such_kind", weighted=False)
    quick = [ML.LOGISTIC, ML.Profile("Random Forest", "forest", trees=5, depth=3, weighted=False), bad]
    rows = ML.compare_baselines(folded.drop("fold"), ["a", "duration"], quick, Roles(), 3).collect()
    assert [r["Model"] for r in rows][-1] == "broken" and "no_such_kind" in rows[-1]["error"]
    assert all(r["error"] is None for r in rows[:-1]) and rows[0]["ROC AUC"] >= rows[1]["ROC AUC"]


def test_importance_and_selection(folded):
    imp = ML.model_importance(folded, ["a", "duration", "leak"], rounds=3)
    top = imp.orderBy(F.desc("importance")).first()
    assert top["feature"] == "leak" and abs(sum(r["importance"] for r in imp.collect()) - 1) < 1e-9
    assert ML.select_by_model(imp, k=1) == ["leak"] and "leak" in ML.select_by_model(imp, quantile=0.5)
    assert len({(p.rounds, p.leaves, p.l2, p.leaf_rows, p.row_frac) for p in (ML.PROFILE_A, ML.PROFILE_B, ML.PROFILE_C)}) == 3


def test_shap_covers_all_rows_and_repeats(spark, folded):
    from tessera.operators import explain as X
    cols = ["a", "duration"]
    p = ML.Profile("shap", "gbt", rounds=3, depth=2, rate=0.05, weighted=False)
    model = ML.fit_table(p, folded, cols).model
    phi = np.concatenate([np.array([list(r)]) for r in X.shap_values(folded, model).collect()])
    assert phi.shape == (folded.count(), 2)
    want = dict(zip(cols, np.abs(phi).mean(axis=0)))
    for df in (folded, folded.repartition(3), folded.orderBy(F.desc("id"))):
        got = {r["feature"]: r["shap_mean_abs"] for r in X.shap_importance(df, cols, Roles(), rounds=3, depth=2).collect()}
        assert all(abs(got[c] - want[c]) < 1e-12 for c in cols)


def test_fold_auc_equals_the_copies(spark):
    """One counting pass against median fill and AUC on copied training rows."""
    from tessera.operators import score as M
    rng = np.random.default_rng(9)
    rows = [(i % 5 + 1, int(rng.random() < 0.4), None if i % 3 == 0 else float(rng.integers(0, 8)),
             None if rng.random() < 0.2 else float(rng.normal()), NAN if i % 4 else 2.0, None) for i in range(400)]
    df = spark.createDataFrame(rows, "fold int, y int, a double, b double, c double, d double")
    cols = ["a", "b", "c", "d"]
    one = {(r["fit_fold"], r["feature"]): r["auc"] for r in M.fold_auc(df, Roles(), cols, 5).collect()}
    copies = S.fold_training_copies(df, 5).drop("fold")
    two = {(r["fit_fold"], r["feature"]): r["auc"] for r in M.univariate_auc(copies, Roles(), cols, by=["fit_fold"]).collect()}
    assert set(one) == set(two) and len(one) == 15 and all(abs(one[k] - two[k]) < 1e-12 for k in one)


def test_linear_shap_of_a_logistic_model(spark, folded):
    from tessera.operators import explain as X
    cols = ["a", "duration", "campaign"]
    m = ML.fit(ML.LOGISTIC, ML.assemble(folded.select("y", *cols), cols)).model
    got = {r["feature"]: r["shap_mean_abs"] for r in X.linear_shap(folded, dict(zip(cols, m.coefficients))).collect()}
    x = folded.select(*cols).toPandas().to_numpy()
    phi = (x - x.mean(axis=0)) * np.array(m.coefficients)
    assert np.allclose([got[c] for c in cols], np.abs(phi).mean(axis=0))
    # additivity: base value + sum of the values is the margin
    margin = x @ np.array(m.coefficients) + m.intercept
    assert np.allclose(phi.sum(axis=1) + margin.mean(), margin)
