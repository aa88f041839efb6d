"""the steps that are fitted inside each fold, in order: cap (T05c) ->
leakers (F07) -> reduction by correlation (F01) or variance (F02) -> feature list (P05) ->
selection by mutual information (F03) or by a boosted model (F04).

Every statistic of fold k comes from its training rows only, and no row is copied: caps and
leakers of all folds come from one shuffle of distinct values with counts for each training part,
the model selection grows all folds' trees in one fit, the others read the rows outside of the
fold. One cap per fold goes on its training, validation and test rows alike. Columns that are
not numeric take no part in reduction and selection and stand behind the kept ones."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import select as SEL
from tessera.operators.clean import apply_cap
from tessera.operators.features import CAP_COLS, apply_cap_by_group, fit_cap_by_group
from tessera.operators.score import fold_auc, fold_caps, near_perfect
from tessera.operators.split import fold_training_copies
from tessera.roles import Roles
from tessera.session import materialize
from tessera.sources.io import kept_columns_log


@dataclass(frozen=True)
class InFold:
    """Which steps run, and their settings; None or False leaves a step out."""
    cap_cols: tuple[str, ...] = CAP_COLS
    cap_q: float | None = None
    drop_leakers: bool = False
    corr_threshold: float | None = None
    feature_list: tuple[str, ...] | None = None
    mi_k: int | None = None
    var_threshold: float | None = None
    model_k: int | None = None
    importance_quantile: float | None = None
    model_rounds: int = 200
    model_depth: int = 5


@dataclass
class FoldSteps:
    """What the steps found: caps and columns of each fold, and the kept-column log."""
    caps: dict[int, dict[str, float]] = field(default_factory=dict)
    columns: dict[int, list[str]] = field(default_factory=dict)
    stages: list[tuple[int, str, str, str, list[str]]] = field(default_factory=list)

    def log(self, spark) -> DataFrame:
        out = None
        for row in self.stages:
            part = kept_columns_log(spark, *row)
            out = part if out is None else out.unionByName(part)
        return out if out is not None else kept_columns_log(spark, 0, "", "", None, [])


def training_copies(folded: DataFrame, steps: InFold, k: int, fold_col: str = "fold") -> tuple[DataFrame, dict]:
    """Each row once for every fold it trains (``fit_fold``), capped with that
    fold's cap; and the caps by (fold, column)."""
    copies = fold_training_copies(folded, k, fold_col)
    cols = [c for c in steps.cap_cols if c in folded.columns]
    if steps.cap_q is None or not 0 < steps.cap_q < 1 or not cols:
        return copies, {}
    caps = fit_cap_by_group(copies, cols, steps.cap_q, "fit_fold")
    return apply_cap_by_group(copies, caps, "fit_fold"), caps


def fit_in_folds(folded: DataFrame, cols: list[str], steps: InFold, roles: Roles = Roles(), k: int = 5,
                 fold_col: str = "fold") -> FoldSteps:
    """Fit the steps of all k folds."""
    out = FoldSteps()
    spark = folded.sparkSession
    kinds = {f.name: f.dataType for f in folded.schema.fields}
    numeric = [c for c in cols if isinstance(kinds[c], T.NumericType)]
    others = [c for c in cols if c not in numeric]
    # several passes read them
    data = materialize(folded.select(fold_col, roles.label, *([roles.key] if roles.key in folded.columns else []), *cols), "in-fold")
    capped = [c for c in steps.cap_cols if c in numeric]
    caps = fold_caps(data, capped, steps.cap_q, k, fold_col) if steps.cap_q is not None and 0 < steps.cap_q < 1 and capped else {}
    for (f, c), v in caps.items():
        out.caps.setdefault(f, {})[c] = v
    leak = set()
    if steps.drop_leakers:
        found = near_perfect(fold_auc(data, roles, numeric, k, fold_col, caps))
        leak = {(r["fit_fold"], r["feature"]) for r in found.collect()}       # folds x columns

    def part(f):
        return apply_cap(data.where(F.col(fold_col) != f), out.caps.get(f, {})).drop(fold_col)

    def reduced(f):
        kept, stages = [c for c in numeric if (f, c) not in leak], []
        if steps.corr_threshold is not None:
            kept = SEL.prune_correlated(part(f), kept, steps.corr_threshold)
            stages.append((f, "reduction", "corr", str(steps.corr_threshold), kept + others))
        elif steps.var_threshold is not None:
            kept = SEL.prune_low_variance(part(f), kept, steps.var_threshold) or kept
            stages.append((f, "reduction", "var", str(steps.var_threshold), kept + others))
        if steps.feature_list is not None:
            kept = [c for c in kept if c in steps.feature_list] or kept
        if steps.mi_k is not None:
            kept = SEL.select_by_mi(part(f), roles, kept, steps.mi_k)
            stages.append((f, "selection", "mi", str(steps.mi_k), kept + others))
        return f, kept, stages

    folds = range(1, k + 1)
    # the folds are independent: their jobs share the cluster
    with ThreadPoolExecutor(max_workers=k) as pool:
        for f, kept, stages in pool.map(reduced, folds):
            out.columns[f] = kept
            out.stages += stages
    if steps.mi_k is None and (steps.model_k is not None or steps.importance_quantile is not None):
        from tessera.operators.boost import Boost, fit_boosted
        from tessera.operators.model import select_by_model
        models = fit_boosted(data, numeric, Boost(rounds=steps.model_rounds, depth=steps.model_depth, rate=0.05), roles.label, roles.key, fold_col,
                             {f: f for f in folds}, 1.0, dict(out.columns), out.caps)
        for f in folds:
            share = [(c, v) for c, v in zip(models[f].cols, models[f].importance()) if c in out.columns[f]]
            rows = spark.createDataFrame(share, "feature string, importance double")
            out.columns[f] = select_by_model(rows, steps.model_k, steps.importance_quantile)
            param = steps.model_k if steps.model_k is not None else steps.importance_quantile
            out.stages.append((f, "selection", "model", str(param), out.columns[f] + others))
    for f in folds:
        out.columns[f] = out.columns[f] + others
    return out
