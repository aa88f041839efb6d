"""Feature reduction and selection: F01-F03, F05-F07 (F04, F08 in model.py).

Selections return Python lists of column names (schema-sized); the data
work behind them is one aggregate per step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.profile import correlation_pairs
from tessera.operators.score import fold_auc, mutual_information, near_perfect
from tessera.roles import Roles

CORR_T = 0.99
VAR_T = 0.01
MI_K = 3
TOP_K = 3
TOP_N = 30


def prune_correlated(df: DataFrame, cols: list[str], threshold: float, keep: str = "last") -> list[str]:
    """for each pair with |r| >= threshold drop the earlier column
    (``keep='last'``, the reference's behaviour, survey Q3) or the later one
    (``keep='first'``). A NULL r never prunes."""
    if len(cols) <= 1:
        return list(cols)
    pairs = correlation_pairs(df, cols, upper_only=True, include_diagonal=False)
    side = "feature_a" if keep == "last" else "feature_b"
    drop = {r[side] for r in pairs.where(F.col("corr").isNotNull() & (F.abs("corr") >= threshold))
            .select(side).collect()}
    return [c for c in cols if c not in drop]


def prune_low_variance(df: DataFrame, cols: list[str], threshold: float) -> list[str]:
    """keep columns whose sample variance exceeds the threshold."""
    if not cols:
        return []
    row = df.agg(*[F.var_samp(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if row[f"v{i}"] is not None and row[f"v{i}"] > threshold]


def select_by_mi(df: DataFrame, roles: Roles, cols: list[str], k: int | None) -> list[str]:
    """the k columns with the highest mutual information (ties by
    name); all columns when k is unset or not smaller than their number."""
    if not cols:
        return []
    if k is None or k >= len(cols):
        return list(cols)
    mi = mutual_information(df, roles, cols)
    return [r["feature"] for r in mi.orderBy(F.desc("mi"), "feature").limit(k).collect()]


def kept_frame(spark, cols: list[str]) -> DataFrame:
    """A kept-columns list as (pos, column_name) (see S12)."""
    return spark.createDataFrame([(i + 1, c) for i, c in enumerate(cols)], "pos long, column_name string")


def top_of_reports(reports: dict[str, DataFrame], n: int = TOP_N, score: str = "score") -> DataFrame:
    """best n rows of each named report as (report, feature, score,
    rank); the window runs over report rows (features), not data."""
    out = None
    for name, rep in reports.items():
        part = rep.select(F.lit(name).alias("report"), "feature", F.col(score).alias("score"))
        out = part if out is None else out.unionByName(part)
    w = Window.partitionBy("report").orderBy(F.desc("score"), "feature")
    return out.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= n)


def leakers_by_fold(folded: DataFrame, roles: Roles, cols: list[str], k: int,
                    fold_col: str = "fold") -> DataFrame:
    """per fold, near-perfect single-feature AUC measured on that fold's
    training part only; all folds from one counting pass."""
    return near_perfect(fold_auc(folded, roles, cols, k, fold_col)).select(F.col("fit_fold").alias("fold"), "feature", "auc")
