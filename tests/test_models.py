"""Tolerance tests for the rows-only model operators: k-means row labels
(J04, M06) and the model save/load round trip (S11)."""

import os
import uuid

import numpy as np
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import functions as F

from tessera.operators import model as ML
from tessera.session import checkpoint_dir
from tessera.sources import io as IO
from tessera.sources.bank import bank_train

SF = "/root/testdata/sf0.001"
NUM = ["age", "balance", "duration", "campaign", "previous"]


def test_kmeans_assign_labels_every_row_once(spark):
    tr = bank_train(spark, SF)
    a = ML.kmeans_assign(tr, 3, NUM, starts=3, keep=("id",))
    assert set(a.columns) == {"id", "cluster", *NUM}
    rows = a.select("id", "cluster").collect()
    assert len(rows) == tr.count()
    assert len({r["id"] for r in rows}) == len(rows)
    assert {r["cluster"] for r in rows} <= {0, 1, 2}
    # same seeds -> same labels
    b = ML.kmeans_assign(tr, 3, NUM, starts=3, keep=("id",)).select("id", F.col("cluster").alias("c2"))
    assert a.join(b, "id").where(F.col("cluster") != F.col("c2")).count() == 0
    # the summary is the per-cluster mean of the original values
    s = {r["cluster"]: r["mean_age"] for r in ML.kmeans_summary(tr, 3, NUM, starts=3).collect()}
    want = {r["cluster"]: r["m"] for r in a.groupBy("cluster").agg(F.avg("age").alias("m")).collect()}
    assert s.keys() == want.keys()
    assert all(abs(s[k] - want[k]) < 1e-9 for k in s)


def test_model_round_trip_scores_equal(spark):
    tr = bank_train(spark, SF).fillna(0)
    cols = ["age", "balance", "duration", "campaign", "previous"]
    x = ML.assemble(tr, cols)
    m = ML.fit(ML.LOGISTIC, x, "y")
    path = IO.save_model(m.model, os.path.join(checkpoint_dir(spark), "models", uuid.uuid4().hex, "lr"))
    back = ML._Fitted(IO.load_model(LogisticRegressionModel, path))
    a = m.score(x, ["id"]).withColumnRenamed("p", "p1")
    b = back.score(x, ["id"]).withColumnRenamed("p", "p2")
    j = a.join(b, "id")
    assert j.count() == tr.count()
    assert j.where(F.abs(F.col("p1") - F.col("p2")) > 1e-12).count() == 0


def test_saved_svm_keeps_its_probabilities(spark, tmp_path):
    tr = bank_train(spark, SF).fillna(0)
    m = ML.fit_table(ML.Profile("SVM", "svm", iters=20, weighted=False, kernel_features=16), tr, NUM)
    back = ML._Fitted.load(spark, m.save(spark, f"{tmp_path}/svm"))
    a = {r["id"]: r["p"] for r in m.score(ML.inputs(m, tr, NUM), ["id"]).collect()}
    b = {r["id"]: r["p"] for r in back.score(ML.inputs(back, tr, NUM), ["id"]).collect()}
    assert back.calib == m.calib and back.fourier == m.fourier is not None and a == b and 0 < min(a.values()) <= max(a.values()) < 1


def test_sweep_settings_equal_their_own_cross_validation(spark):
    """Columns of each fold fitted together against one cross-validation for each setting."""
    from tessera.operators import split as S
    folded = S.stratified_kfold(bank_train(spark, SF), 3)
    p = ML.Profile("b", "gbt", rounds=3, depth=3, rate=0.3)
    settings = {"one": {f: ["duration", "age"] for f in (1, 2, 3)}, "two": {1: ["duration"], 2: ["duration", "age"], 3: ["age"]}}
    got = ML.cross_validate_columns(folded, settings, p, k=3)
    assert all(df.count() == folded.count() for df in got.values())
    same = got["one"].where("fold = 2").withColumnRenamed("p", "q").join(got["two"].where("fold = 2"), "id")
    assert same.where("q <> p").count() == 0
    full = ML.cross_validate(folded, ["duration", "age"], ML.Profile("b", "gbt", rounds=3, depth=3, rate=0.3, col_frac=1.0, row_frac=1.0), k=3)
    alone = ML.cross_validate_columns(folded, {"one": settings["one"]}, ML.Profile("b", "gbt", rounds=3, depth=3, rate=0.3, col_frac=1.0, row_frac=1.0), k=3)
    both = full.oof.withColumnRenamed("p", "q").join(alone["one"], "id")
    assert both.count() == folded.count() and both.where("abs(q - p) > 1e-12").count() == 0
    full.release()


def test_fourier_features_approach_the_kernel_and_split_two_rings(spark):
    import numpy as np
    rng = np.random.default_rng(6)
    n = 600
    y = np.arange(n) % 2
    angle, radius = rng.uniform(0, 2 * np.pi, n), np.where(y == 1, 2.0, 0.7) + rng.normal(0, 0.15, n)
    rows = [(int(i), float(r * np.cos(a)), float(r * np.sin(a)), int(v)) for i, (a, r, v) in enumerate(zip(angle, radius, y))]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    x = ML.assemble(df, ["a", "b"])
    gamma, d = ML.kernel_width(x)
    cells = np.array([r[1:3] for r in rows])
    assert d == 2 and abs(gamma - 1 / (2 * cells.var())) < 1e-9
    z = np.array([r["features"].toArray() for r in ML.Fourier(gamma, 2000, 2).apply(x).orderBy("id").limit(60).collect()])
    kernel = np.exp(-gamma * ((cells[:60, None] - cells[None, :60]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - kernel).max() < 0.12
    auc = {}
    for kernel_features in (0, 64):
        m = ML.fit_table(ML.Profile("SVM", "svm", iters=30, weighted=False, kernel_features=kernel_features), df, ["a", "b"])
        auc[kernel_features] = ML.roc_auc(m.score(x, ["y"]), "y", "p").first()["auc"]
    assert auc[64] > 0.98 and auc[0] < 0.7


def test_fourier_features_of_many_rows_at_once(spark):
    """The features are sqrt(2/n) cos(w x + b), made by the batch: no expression per feature and row."""
    import numpy as np
    from pyspark.ml.functions import vector_to_array
    from tessera.operators import model as ML
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 3))
    df = ML.assemble(spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double"), ["a", "b", "c"])
    k = ML.Fourier(0.3, 16, 3)
    made = k.apply(df)
    assert made.columns == df.columns
    assert "lambdafunction" not in made._jdf.queryExecution().optimizedPlan().toString().lower()
    w = k.weights()
    want = np.sqrt(2 / 16) * np.cos(x @ w[:, :3].T + w[:, 3])
    got = {r["id"]: r["f"] for r in made.select("id", vector_to_array("features").alias("f")).collect()}
    assert np.allclose([got[i] for i in range(500)], want)
    assert k.apply(df.where("id < 0")).count() == 0


def test_kmeans_reads_its_input_once(spark):
    """The joins behind a table run once, into a written copy that medians, fits and labels read; nothing stays cached."""
    left = spark.createDataFrame([(i, float(i % 50), float(i % 3) if i % 7 else None) for i in range(300)], "id long, a double, b double")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    out = ML.kmeans_assign(left.repartition(3).mapInArrow(counted, left.schema), 3, ["a", "b"], starts=3, keep=("id",))
    assert sorted(r["id"] for r in out.collect()) == list(range(300)) and {r["cluster"] for r in out.collect()} == {0, 1, 2}
    assert seen.value == 300
    assert not out.storageLevel.useMemory and "InMemoryTableScan" not in out._jdf.queryExecution().toString()


def test_folds_of_a_large_table_are_not_held_together(spark, monkeypatch):
    """Fits run together as long as what they cache stays within FIT_BYTES; the scores don't depend on it."""
    import threading
    p = ML.Profile("SVM", "svm", iters=5, weighted=False, kernel_features=8)
    assert ML.fits_at_once(p, 1000, 2, 5) == 5 and ML.fits_at_once(p, ML.FIT_BYTES // 64 // 2, 2, 5) == 2
    assert ML.fits_at_once(p, ML.FIT_BYTES, 2, 5) == 1 and ML.fits_at_once(p, ML.FIT_BYTES // 64 // 2, 2, 5, share=2) == 1
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=600), rng.normal(size=600)
    df = spark.createDataFrame([(i, float(u), float(v), int(u * v > 0), i % 3 + 1) for i, (u, v) in enumerate(zip(a, b))],
                               "id long, a double, b double, y int, fold int")
    running, most, lock, real = [0], [0], threading.Lock(), ML.fit

    def watched(*args, **kw):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        try:
            return real(*args, **kw)
        finally:
            with lock:
                running[0] -= 1

    monkeypatch.setattr(ML, "fit", watched)
    found = []
    for held, at_once in ((ML.FIT_BYTES, 3), (1, 1)):
        monkeypatch.setattr(ML, "FIT_BYTES", held)
        most[0] = 0
        res = ML.cross_validate(df, ["a", "b"], p, k=3)
        assert most[0] <= at_once and (most[0] == 1) == (at_once == 1)
        found.append([round(r["roc_auc"], 6) for r in res.metrics.orderBy("fold").collect()])
        res.release()
    assert found[0] == found[1]
