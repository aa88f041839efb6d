"""Sampling and splitting: X01-X04.

Row order comes from md5(seed | key), so the split is reproducible in any
engine and needs no ``rand()``. Ranks within a class come from one range-partitioned write: rows
sorted by (class, order) land in files, the rows of each class in each file are counted, the counts become
offsets, and a row's rank is its position in the file plus its class's offset. No window
holds a class, the input is not read again and nothing is joined on the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize

SEED = 42


def order_hash(key: str, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def _ranked(df: DataFrame, by: str, order: list[str], parts: int | None = None) -> DataFrame:
    """Adds ``_rank`` (1-based, by ``order``) within the ``by`` class and ``_n``, the class's rows. ``parts``
    ranges are written; unset, as many as the session's shuffles have."""
    cols = df.columns
    ranges = df.repartitionByRange(parts, by, *order) if parts else df.repartitionByRange(by, *order)
    placed = (materialize(ranges.sortWithinPartitions(by, *order), "ranks")
              .select(*cols, F.col("_metadata.file_name").alias("_f"), F.col("_metadata.row_index").alias("_i")))
    parts = placed.groupBy(F.col(by).alias("_by"), F.col("_f").alias("_file")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_i").alias("_first"), F.min(F.struct(*order)).alias("_start"))
    # files x classes rows from here on
    whole = Window.partitionBy("_by")
    before = whole.orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_by", "_file", (F.coalesce(F.sum("_c").over(before), F.lit(0)) - F.col("_first") + 1).alias("_off"),
                           F.sum("_c").over(whole).alias("_n"))
    return (placed.join(F.broadcast(offsets), F.col(by).eqNullSafe(F.col("_by")) & (F.col("_f") == F.col("_file")))
            .withColumn("_rank", F.col("_i") + F.col("_off")).drop("_f", "_i", "_by", "_file", "_off"))


def rank_by_hash(df: DataFrame, key: str, by: str, seed: int = SEED, parts: int | None = None) -> DataFrame:
    """Adds ``_rank`` (1-based) of each row inside its ``by`` class, ordered
    by (md5(seed|key), key), and ``_n``, the rows of the class."""
    return _ranked(df.withColumn("_h", order_hash(key, seed)), by, ["_h", key], parts).drop("_h")


def rank_by_key(df: DataFrame, key: str, by: str, parts: int | None = None) -> DataFrame:
    """``_rank`` inside the class ordered by key, and ``_n``."""
    return _ranked(df, by, [key], parts)


def stratified_kfold(df: DataFrame, k: int = 5, seed: int = SEED, key: str = "id", label: str = "y",
                     shuffle: bool = True, fold_col: str = "fold") -> DataFrame:
    """fold = (rank - 1) mod k + 1 inside each class."""
    r = rank_by_hash(df, key, label, seed) if shuffle else rank_by_key(df, key, label)
    return r.withColumn(fold_col, ((F.col("_rank") - 1) % k + 1).cast("int")).drop("_rank", "_n")


def stratified_holdout(df: DataFrame, frac: float = 0.2, seed: int = SEED, key: str = "id",
                       label: str = "y", part_col: str = "part") -> DataFrame:
    """The first ceil(frac * class size) rows of each class by hash
    order are 'valid', the rest 'train'."""
    r = rank_by_hash(df, key, label, seed)
    return (r.withColumn(part_col, F.when(F.col("_rank") <= F.ceil(F.col("_n") * F.lit(frac)), "valid")
                         .otherwise("train")).drop("_rank", "_n"))


def sample_rows(df: DataFrame, n: int, seed: int = SEED, key: str = "id") -> DataFrame:
    """At most n rows, uniform without replacement: the n smallest
    hashes (TakeOrdered keeps n rows per task, then n overall)."""
    return df.orderBy(order_hash(key, seed), F.col(key)).limit(n)


def fold_training_copies(df: DataFrame, k: int, fold_col: str = "fold", as_col: str = "fit_fold") -> DataFrame:
    """Each row once for every fold whose training part it belongs to
    (k - 1 copies), tagged ``fit_fold``: per-fold statistics then become
    one grouped aggregate instead of k jobs."""
    folds = F.array(*[F.lit(i) for i in range(1, k + 1)])
    return (df.withColumn(as_col, F.explode(F.filter(folds, lambda f: f != F.col(fold_col)))))
