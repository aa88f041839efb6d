"""Models, cross-validation and model-based scores: L01-L08, M04, M06, F04,
F08, E06-E08, E11.

Boosted trees are the histogram booster of :mod:`tessera.operators.boost`, all folds in one
fit; the other fits are Spark ML estimators, one per fold on the same cached,
fold-tagged table. Predictions stay DataFrames keyed by id.
"""

from __future__ import annotations

import logging
import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import (LinearSVC, LinearSVCModel, LogisticRegression, LogisticRegressionModel,
                                       RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.boost import Boost, Boosted, fit_boosted
from tessera.operators.evaluate import accuracy, fold_metrics, mean_std
from tessera.operators.score import roc_auc
from tessera.roles import Roles
from tessera.session import materialize

SEED = 42
FIT_BYTES = 4 << 30     # of rows that fits which run together hold in the cluster
log = logging.getLogger(__name__)


# ---------------------------------------------------------------- profiles L01-L06

@dataclass(frozen=True)
class Profile:
    """A named estimator configuration."""
    name: str
    kind: str            # gbt | logistic | forest | svm
    rounds: int = 600
    depth: int = 6
    rate: float = 0.03
    row_frac: float = 0.8
    col_frac: float = 0.8
    bins: int = 254
    leaf_rows: int = 1
    leaf_hessian: float = 1.0
    leaves: int | None = None
    l2: float = 1.0
    trees: int = 100
    iters: int = 1000
    weighted: bool = True
    kernel_features: int = 0     # svm: random Fourier features of the RBF kernel; 0 is the linear kernel


# Three boosted-tree configurations and the baselines. A and C grow
# by level; B grows best first to 63 leaves of at least 20 rows; C has an L2 leaf
# term of 3 and samples neither rows nor columns.
PROFILE_A = Profile("boosted_a", "gbt", rounds=600, depth=6, rate=0.03)
PROFILE_B = Profile("boosted_b", "gbt", rounds=1200, leaves=63, rate=0.03, l2=0.0, leaf_rows=20, leaf_hessian=1e-3)
PROFILE_C = Profile("boosted_c", "gbt", rounds=1000, depth=6, rate=0.03, row_frac=1.0, col_frac=1.0, l2=3.0)
LOGISTIC = Profile("Logistic Regression", "logistic", weighted=False)
FOREST = Profile("Random Forest", "forest", trees=100, depth=30, weighted=False)     # the library's deepest
SVM = Profile("SVM", "svm", iters=100, weighted=False, kernel_features=256)


def boost_settings(p: Profile) -> Boost:
    return Boost(rounds=p.rounds, depth=p.depth, leaves=p.leaves, rate=p.rate, row_frac=p.row_frac, col_frac=p.col_frac, bins=p.bins,
                 l2=p.l2, leaf_rows=p.leaf_rows, leaf_hessian=p.leaf_hessian, seed=SEED)


def estimator(p: Profile, n_rows: int | None = None, weight_col: str | None = None):
    if p.kind == "logistic":
        # unit inverse regularisation strength on a summed loss = 1/n on a mean loss
        e = LogisticRegression(maxIter=p.iters, regParam=1.0 / max(n_rows or 1, 1), elasticNetParam=0.0,
                               standardization=False)
    elif p.kind == "forest":
        e = RandomForestClassifier(numTrees=p.trees, maxDepth=p.depth, seed=SEED, featureSubsetStrategy="sqrt")
    elif p.kind == "svm":
        e = LinearSVC(maxIter=p.iters, regParam=1.0 / max(n_rows or 1, 1))
    else:
        raise ValueError(p.kind)
    if weight_col and p.weighted:
        e = e.setWeightCol(weight_col)
    return e


def held_bytes(p: Profile, cols: int) -> int:
    """About what a Spark ML fit caches for a row: doubles, for a forest bins, counts of its trees and objects around them."""
    return 160 + 4 * (cols + p.trees) if p.kind == "forest" else 8 * (p.kernel_features if p.kind == "svm" and p.kernel_features else cols)


def fits_at_once(p: Profile, rows: int, cols: int, most: int, share: int = 1) -> int:
    """How many of ``most`` independent fits run together, so that what they cache stays within FIT_BYTES (a ``share``-th of it). Rows that
    spill are read from disk in each of a fit's iterations, and on a large table one fit keeps all cores busy."""
    return max(1, min(most, FIT_BYTES // share // max(1, rows * held_bytes(p, cols))))


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="error").transform(df)


def with_class_weight(df: DataFrame, label: str, w: float, col: str = "w") -> DataFrame:
    """Positives weighted by negatives / positives (A15); always applied
    when the profile asks for it (survey Q10)."""
    return df.withColumn(col, F.when(F.col(label) == 1, F.lit(float(w))).otherwise(F.lit(1.0)))


@dataclass(frozen=True)
class Fourier:
    """Random Fourier features of the RBF kernel exp(-gamma |x - y|^2) (Rahimi and Recht): sqrt(2/n) cos(w x + b) with w from
    N(0, 2 gamma) and b uniform, drawn from ``seed``. Dot products of two rows' features approach the kernel as n grows."""
    gamma: float
    n: int
    d: int
    seed: int = SEED

    def weights(self) -> np.ndarray:
        """(n, d + 1): w, and b last."""
        rng = np.random.default_rng(self.seed)
        return np.concatenate([rng.normal(scale=math.sqrt(2 * self.gamma), size=(self.n, self.d)), rng.uniform(0, 2 * math.pi, (self.n, 1))], axis=1)

    def apply(self, df: DataFrame, col: str = "features") -> DataFrame:
        """``col`` replaced by its features, a batch of rows at a time."""
        w = self.weights()

        @F.arrow_udf("array<double>")
        def wave(rows: pa.Array) -> pa.Array:
            x = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), len(w.T) - 1)
            total = np.zeros((len(x), len(w)))
            for i in range(x.shape[1]):
                total += x[:, i:i + 1] * w[:, i]
            total = math.sqrt(2 / len(w)) * np.cos(total + w[:, -1])
            return pa.ListArray.from_arrays(pa.array(np.arange(0, total.size + 1, len(w)), pa.int32()), pa.array(total.reshape(-1)))

        return df.withColumn(col, array_to_vector(wave(vector_to_array(col))))


def kernel_width(df: DataFrame, col: str = "features") -> tuple[float, int]:
    """(1 / (d * variance of all cells), d) of a vector column, the usual scale of an RBF kernel."""
    d = len(df.select(col).first()[0])
    cell = F.explode(vector_to_array(col))
    v = df.select(cell.alias("v")).agg(F.var_pop("v")).first()[0]
    return (1.0 / (d * v) if v else 1.0), d


class _Fitted:
    """A fitted model plus, for SVM, the logistic calibration of its margin and its kernel's features."""

    def __init__(self, model, calib=None, fourier: Fourier | None = None):
        self.model, self.calib, self.fourier = model, calib, fourier

    def save(self, spark, path: str) -> str:
        """The model, and beside it what ``load`` needs to score as before."""
        kind = "boosted" if isinstance(self.model, Boosted) else type(self.model).__name__
        if kind == "boosted":
            self.model.save(spark, path)
        else:
            self.model.write().overwrite().save(path)
        a, b = self.calib or (None, None)
        k = self.fourier
        spark.createDataFrame([(kind, a, b, *((k.gamma, k.n, k.d, k.seed) if k else (None,) * 4))],
                              "kind string, slope double, intercept double, gamma double, n int, d int, seed int").write.mode("overwrite").parquet(f"{path}/fitted")
        return path

    @classmethod
    def load(cls, spark, path: str) -> _Fitted:
        r = spark.read.parquet(f"{path}/fitted").first()
        if r["kind"] == "boosted":
            return cls(Boosted.load(spark, path))
        kinds = {c.__name__: c for c in (LogisticRegressionModel, RandomForestClassificationModel, LinearSVCModel)}
        return cls(kinds[r["kind"]].load(path), (r["slope"], r["intercept"]) if r["slope"] is not None else None,
                   Fourier(r["gamma"], r["n"], r["d"], r["seed"]) if r["gamma"] is not None else None)

    def score(self, df: DataFrame, keep: list[str], out: str = "p") -> DataFrame:
        """``df`` has the ``features`` vector, for boosted trees the columns themselves."""
        if isinstance(self.model, Boosted):
            return self.model.score(df, keep, out)
        s = self.model.transform(self.fourier.apply(df) if self.fourier else df)
        if self.calib is None:
            return s.select(*keep, vector_to_array("probability")[1].alias(out))
        m = s.select(*keep, vector_to_array("rawPrediction")[1].alias("_m"))
        a, b = self.calib
        return m.select(*keep, (F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) * F.col("_m") + F.lit(b))))).alias(out))


def fit(p: Profile, train: DataFrame, label: str = "y", weight: float | None = None) -> _Fitted:
    """Fit one profile of Spark ML on an assembled table (``features`` column)."""
    n = None
    if p.kind in ("logistic", "svm"):
        n = train.count()
    wcol = None
    if weight is not None and p.weighted:
        train = with_class_weight(train, label, weight)
        wcol = "w"
    fourier = None
    if p.kind == "svm" and p.kernel_features:
        gamma, d = kernel_width(train)
        fourier = Fourier(gamma, p.kernel_features, d)
        train = fourier.apply(train)
    est = estimator(p, n, wcol).setLabelCol(label).setFeaturesCol("features")
    model = est.fit(train)
    if p.kind != "svm":
        return _Fitted(model)
    # Platt scaling: logistic regression of the label on the SVM margin
    marg = model.transform(train).select(F.col(label), vector_to_array("rawPrediction")[1].alias("m")).persist(StorageLevel.MEMORY_AND_DISK)
    lr = LogisticRegression(maxIter=100, regParam=0.0, featuresCol="mv", labelCol=label).fit(
        VectorAssembler(inputCols=["m"], outputCol="mv").transform(marg))
    marg.unpersist()
    return _Fitted(model, (float(lr.coefficients[0]), float(lr.intercept)), fourier)


def fit_table(p: Profile, df: DataFrame, cols: list[str], roles: Roles = Roles(), weight: float | None = None) -> _Fitted:
    """Fit any profile on all rows of a table of plain columns."""
    if p.kind == "gbt":
        w = weight if weight is not None and p.weighted else 1.0
        return _Fitted(fit_boosted(df, cols, boost_settings(p), roles.label, roles.key, weight=w)[0])
    return fit(p, assemble(df, cols), roles.label, weight)


def inputs(m: _Fitted | Profile, df: DataFrame, cols: list[str]) -> DataFrame:
    """What ``score`` of this kind of model reads."""
    boosted = m.kind == "gbt" if isinstance(m, Profile) else isinstance(m.model, Boosted)
    return df if boosted else assemble(df, cols)


# ---------------------------------------------------------------- L07 / E05-E07

@dataclass
class CVResult:
    oof: DataFrame          # key, fold, y, p      (E06)
    test: DataFrame | None  # key, p (mean over folds, E07)
    metrics: DataFrame      # fold, roc_auc; fold 0 = pooled OOF (E05)
    models: list
    held: tuple = ()
    steps: object = None    # what the in-fold steps found (FoldSteps)

    def release(self) -> None:
        """Drop the cached fold table (results stay valid: they recompute
        from lineage if read again)."""
        for h in self.held:
            h.unpersist()


def cross_validate(folded: DataFrame, cols: list[str], p: Profile, test: DataFrame | None = None,
                   roles: Roles = Roles(), k: int = 5, fold_col: str = "fold", parallel_fits: int = 5,
                   steps=None, model_dir: str | None = None, share: int = 1) -> CVResult:
    """For each fold fit on the other folds, score the fold and the
    test table. The class weight is measured once on all training rows. Up to ``parallel_fits`` folds are fitted at once, fewer
    on a large table (``share``: how many callers share what fits may hold).
    ``steps`` (an :class:`~tessera.operators.infold.InFold`) are fitted in each
    fold first; ``model_dir`` gets each fold's model (S11)."""
    from tessera.operators.clean import apply_cap
    from tessera.operators.infold import FoldSteps, fit_in_folds
    from tessera.operators.profile import class_weight_value
    key, label = roles.key, roles.label
    data = folded.select(key, fold_col, label, *cols).persist(StorageLevel.MEMORY_AND_DISK)
    tdata = test.select(key, *cols).persist(StorageLevel.MEMORY_AND_DISK) if test is not None else None
    fitted = fit_in_folds(data, cols, steps, roles, k, fold_col) if steps is not None else FoldSteps()
    w = class_weight_value(data, label)

    def rows(df, f):
        """Fold f's view of a table: its cap, its columns."""
        return inputs(p, apply_cap(df, fitted.caps.get(f, {})), fitted.columns.get(f, cols))

    if p.kind == "gbt":
        boosted = fit_boosted(data, cols, boost_settings(p), label, key, fold_col, {f: f for f in range(1, k + 1)},
                              w if p.weighted else 1.0, fitted.columns, fitted.caps)
        models = [_Fitted(boosted[f]) for f in range(1, k + 1)]
    else:
        # The k fits are independent: submit them from a small thread pool so
        # their jobs share the cluster instead of queueing behind each other.
        with ThreadPoolExecutor(max_workers=fits_at_once(p, data.count(), len(cols), min(k, parallel_fits), share)) as pool:
            models = list(pool.map(lambda f: fit(p, rows(data.where(F.col(fold_col) != f), f), label, w), range(1, k + 1)))
    oofs, tests = [], []
    for f, m in zip(range(1, k + 1), models):
        if model_dir is not None:
            m.save(data.sparkSession, f"{model_dir}/fold_{f}")
        oofs.append(m.score(rows(data.where(F.col(fold_col) == f), f), [key, fold_col, label]))
        if tdata is not None:
            tests.append(m.score(rows(tdata, f), [key]).withColumn(fold_col, F.lit(f)))
    oof = reduce(DataFrame.unionByName, oofs)
    tmean = reduce(DataFrame.unionByName, tests).groupBy(key).agg(F.avg("p").alias("p")) if tests else None
    held = (data,) if tdata is None else (data, tdata)
    return CVResult(oof, tmean, fold_metrics(oof, label, "p", fold_col), models, held, fitted)


def cross_validate_columns(folded: DataFrame, settings: dict, p: Profile, roles: Roles = Roles(), k: int = 5,
                           fold_col: str = "fold", parallel_fits: int = 5) -> dict:
    """The out-of-fold predictions (key, fold, y, p) of each setting, a setting being the columns of each
    fold: ``{setting: {fold: columns}}``. Settings that keep the same columns in a fold share its fit; boosted
    trees of all settings grow in one fit."""
    from tessera.operators.profile import class_weight_value
    key, label = roles.key, roles.label
    jobs = sorted({(f, tuple(cols)) for folds in settings.values() for f, cols in folds.items()})
    every = list(dict.fromkeys(c for _, cols in jobs for c in cols))
    data = folded.select(key, fold_col, label, *every)
    w = class_weight_value(data, label)
    if p.kind == "gbt":
        models = fit_boosted(data, every, boost_settings(p), label, key, fold_col, {i: f for i, (f, _) in enumerate(jobs)},
                             w if p.weighted else 1.0, {i: list(cols) for i, (_, cols) in enumerate(jobs)})
        fitted = {job: _Fitted(models[i]) for i, job in enumerate(jobs)}
    else:
        with ThreadPoolExecutor(max_workers=fits_at_once(p, data.count(), len(every), parallel_fits)) as pool:
            fitted = dict(zip(jobs, pool.map(lambda j: fit(p, assemble(data.where(F.col(fold_col) != j[0]), list(j[1])), label, w), jobs)))
    scored = {j: m.score(inputs(m, data.where(F.col(fold_col) == j[0]), list(j[1])), [key, fold_col, label]) for j, m in fitted.items()}
    return {s: reduce(DataFrame.unionByName, [scored[f, tuple(cols)] for f, cols in sorted(folds.items())]) for s, folds in settings.items()}


# ---------------------------------------------------------------- L08 / E08

def compare_baselines(train: DataFrame, cols: list[str], profiles: list[Profile], roles: Roles = Roles(),
                      k: int = 5, holdout: float = 0.2, model_dir: str | None = None) -> DataFrame:
    """L08 + E08: each profile's holdout AUC and accuracy and its k-fold AUC
    mean/sd (unshuffled stratified folds of the training part); a profile
    that fails is reported with NULLs and its ``error``, and the rest continue. Best first.
    ``model_dir`` gets each fitted baseline (S11)."""
    from tessera.operators.split import stratified_holdout, stratified_kfold
    spark = train.sparkSession
    parts = stratified_holdout(train.select(roles.key, roles.label, *cols), holdout)
    parts = parts.persist(StorageLevel.MEMORY_AND_DISK)
    tr, va = parts.where(F.col("part") == "train").drop("part"), parts.where(F.col("part") == "valid").drop("part")
    def run(p):
        try:
            m = fit_table(p, tr, cols, roles)
            if model_dir is not None:
                m.save(spark, f"{model_dir}/{p.name.lower().replace(' ', '_')}")
            s = m.score(inputs(m, va, cols), [roles.label])
            auc = roc_auc(s, roles.label, "p").first()
            acc = accuracy(s.withColumn("pred", (F.col("p") >= 0.5).cast("int")), roles.label).first()
            cv = cross_validate(stratified_kfold(tr, k, shuffle=False), cols, p, None, roles, k, share=len(profiles))
            ms = mean_std(cv.metrics.where(F.col("fold") > 0), "roc_auc").first()
            cv.release()
            return (p.name, auc["auc"] if auc else None, acc["accuracy"], ms["mean"], ms["std"], None)
        except Exception as e:  # noqa: BLE001 -- the others go on; the reason is logged and returned
            log.exception("baseline %s failed", p.name)
            return (p.name, None, None, None, None, f"{type(e).__name__}: {e}"[:2000])

    # the models are independent: their jobs share the cluster
    with ThreadPoolExecutor(max_workers=max(1, len(profiles))) as pool:
        rows = list(pool.map(run, profiles))
    parts.unpersist()
    df = spark.createDataFrame(rows, "Model string, `ROC AUC` double, Accuracy double, "
                                     "`CV ROC AUC Mean` double, `CV ROC AUC Std` double, error string")
    return df.orderBy(F.col("ROC AUC").desc_nulls_last(), "Model")


# ---------------------------------------------------------------- M04 / F04

def model_importance(train: DataFrame, cols: list[str], roles: Roles = Roles(), rounds: int = 400,
                     depth: int = 6, rate: float = 0.05) -> DataFrame:
    """Normalised split-gain importance of a quick boosted model,
    as (feature, importance)."""
    p = Profile("importance", "gbt", rounds=rounds, depth=depth, rate=rate, weighted=False)
    imp = fit_table(p, train, cols, roles).model.importance()
    return train.sparkSession.createDataFrame([(c, float(v)) for c, v in zip(cols, imp)],
                                              "feature string, importance double")


def select_by_model(importance: DataFrame, k: int | None = None, quantile: float | None = None) -> list[str]:
    """top k by importance when k is given, else importance >= its
    quantile; never empty (all columns when nothing passes)."""
    rows = importance.orderBy(F.desc("importance"), "feature").collect()
    cols = [r["feature"] for r in rows]
    if k is not None and k > 0:
        return cols[:min(k, len(cols))]
    if quantile is not None and 0.0 <= quantile <= 1.0:
        from tessera.functions.quantiles import column_quantiles
        thr = column_quantiles(importance, ["importance"], [quantile])["importance"][0]
        keep = [r["feature"] for r in rows if r["importance"] >= thr]
        return keep or cols
    return cols


# ---------------------------------------------------------------- M06

def kmeans_assign(df: DataFrame, k: int, cols: list[str], starts: int = 10, seed: int = SEED,
                  keep: tuple[str, ...] = (), parallel_starts: int = 5, centres: list[list[float]] | None = None) -> DataFrame:
    """Fit k-means on median-filled copies of ``cols`` (best of
    ``starts`` seeds by training cost) and attach ``cluster`` to every row.
    Given ``centres`` (k rows of ``cols``) nothing is fitted: a row goes to its
    nearest one, the first on ties.
    ``transform`` keeps the row's columns, so no join is needed; the
    original (unfilled) values of ``cols`` and the ``keep`` columns stay."""
    from tessera.operators.clean import fit_median
    from tessera.operators.score import _finite_numeric
    base = _finite_numeric(df.select(*keep, *cols), cols)
    if centres is None:     # the medians' passes, the fits and the labels read it
        base = materialize(base, "k-means")
    med = fit_median(base, cols)
    fcols = [f"_f_{c}" for c in cols]
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(med[c]).cast("double")).alias(f) for c, f in zip(cols, fcols)]
    if centres is not None:
        if len(centres) != k:
            raise ValueError(f"{len(centres)} centres for k = {k}")
        far = [sum(((F.col(f) - F.lit(float(x))) * (F.col(f) - F.lit(float(x))) for f, x in zip(fcols, centre)), F.lit(0.0))
               for centre in centres]
        nearest = F.array_min(F.array(*[F.struct(d.alias("d"), F.lit(i).alias("i")) for i, d in enumerate(far)]))
        return base.select(*keep, *cols, *filled).withColumn("cluster", nearest["i"]).drop(*fcols)
    rows = assemble(base.select(*keep, *cols, *filled), fcols)
    vec = rows.select("features").persist(StorageLevel.MEMORY_AND_DISK)     # all that the fits read
    vec.count()

    def fit_start(s):
        m = KMeans(k=k, seed=seed + s, featuresCol="features", predictionCol="cluster").fit(vec)
        return m.summary.trainingCost, s, m

    # the starts are independent: submit them together so their jobs share
    # the cluster; least cost wins, the earliest seed on ties
    with ThreadPoolExecutor(max_workers=min(starts, parallel_starts)) as pool:
        fits = list(pool.map(fit_start, range(starts)))
    best = min(fits, key=lambda t: (t[0], t[1]))[2]
    vec.unpersist()
    return best.transform(rows).drop("features", *fcols)


def kmeans_summary(df: DataFrame, k: int, cols: list[str], starts: int = 10, seed: int = SEED,
                   centres: list[list[float]] | None = None) -> DataFrame:
    """The mean of each original column per k-means cluster."""
    return kmeans_assign(df, k, cols, starts, seed, centres=centres).groupBy("cluster").agg(
        *[F.avg(c).alias(f"mean_{c}") for c in cols])
