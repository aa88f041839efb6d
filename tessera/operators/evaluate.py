"""Metrics and result assembly: E02-E05, E13 (E01 lives in score.py)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.score import auc_of_counts


def accuracy(df: DataFrame, label: str = "y", pred: str = "pred") -> DataFrame:
    """Share of rows whose predicted class equals the label."""
    return df.agg(F.avg((F.col(pred).cast("int") == F.col(label).cast("int")).cast("double")).alias("accuracy"))


def confusion_metrics(df: DataFrame, label: str = "y", pred: str = "pred") -> DataFrame:
    """Precision, recall and F1 of the positive class, one aggregate."""
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    c = df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
               F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))
    prec = F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp"))
    rec = F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn"))
    return c.select("tp", "fp", "fn", "tn", F.coalesce(prec, F.lit(0.0)).alias("precision"),
                    F.coalesce(rec, F.lit(0.0)).alias("recall"),
                    F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0)).alias("f1"))


def mean_std(df: DataFrame, col: str = "roc_auc") -> DataFrame:
    """Mean and population sd of per-fold scores."""
    return df.agg(F.avg(col).alias("mean"), F.stddev_pop(col).alias("std"))


def fold_metrics(oof: DataFrame, label: str = "y", score: str = "p", fold: str = "fold") -> DataFrame:
    """AUC per fold plus fold 0 = AUC of all out-of-fold scores pooled."""
    # rows per (fold, score) first; the pooled part re-aggregates them as fold 0
    y = F.col(label).cast("int")
    counts = (oof.select(F.col(fold).cast("int").alias("fold"), F.col(score).cast("double").alias("value"), y.alias("y"))
              .where(F.col("value").isNotNull()).groupBy("fold", "value").agg(F.sum("y").alias("pos"), F.sum(F.lit(1) - F.col("y")).alias("neg")))
    both = counts.select(F.explode(F.array(F.col("fold"), F.lit(0))).alias("fold"), "value", "pos", "neg")
    return auc_of_counts(both, ["fold"]).select("fold", F.col("auc").alias("roc_auc"))


def best_setting(results: DataFrame, score: str, position: str) -> DataFrame:
    """Highest score, the earliest setting on ties (a one-row top-1)."""
    return results.orderBy(F.desc(score), F.asc(position)).limit(1)


def top_k(report: DataFrame, score: str, k: int, name: str = "feature") -> DataFrame:
    """Best k rows by score, name as tie-break."""
    return report.where(F.col(name).isNotNull()).orderBy(F.desc(score), F.asc(name)).limit(k)


def ranked(report: DataFrame, score: str, name: str = "feature") -> DataFrame:
    """Rank by score descending with the name as tie-break (the report
    is columns-sized, so one window is fine)."""
    w = Window.orderBy(F.desc(score), F.asc(name))
    return report.withColumn("rank", F.row_number().over(w))
