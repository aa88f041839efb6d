"""Combining tables: P03, P04, U01, J01-J03.

Joins are declared and the planner picks the strategy: with AQE on, a side
whose measured size is under ``spark.sql.autoBroadcastJoinThreshold`` is
broadcast, anything larger is shuffled; skewed partitions are split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import clip


def aligned_columns(train: DataFrame, test: DataFrame, label: str = "y", split: str = "split") -> list[str]:
    """Sorted union of both tables' columns, label excluded (survey Q1)."""
    return sorted((set(train.columns) | set(test.columns)) - {label, split})


def _project(df: DataFrame, cols: list[str], types: dict) -> DataFrame:
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in cols])


def align_and_union(train: DataFrame, test: DataFrame | None, label: str = "y",
                    split: str = "split") -> DataFrame:
    """P03 + U01: one table of sorted feature columns, ``label`` (NULL on
    test rows) and ``split`` in {'train', 'test'}."""
    test = test if test is not None else train.limit(0).drop(label)
    cols = aligned_columns(train, test, label, split)
    types = {f.name: f.dataType for f in test.schema.fields}
    types.update({f.name: f.dataType for f in train.schema.fields})
    ytype = types.get(label, "int")
    ya = F.col(label).cast(ytype) if label in train.columns else F.lit(None).cast(ytype)
    a = train.select(*[F.col(c) if c in train.columns else F.lit(None).cast(types[c]).alias(c) for c in cols],
                     ya.alias(label), F.lit("train").alias(split))
    b = _project(test, cols, types).withColumn(label, F.lit(None).cast(ytype)).withColumn(split, F.lit("test"))
    return a.unionByName(b)


def schema_diff(train: DataFrame, test: DataFrame) -> tuple[list[str], list[str]]:
    """(only in train, only in test), by name."""
    a, b = set(train.columns), set(test.columns)
    return sorted(a - b), sorted(b - a)


def join_external(combined: DataFrame, externals: list[DataFrame], key: str = "id") -> DataFrame:
    """Chained left joins on ``key``. A table without the key is
    skipped; duplicate keys multiply rows; names present on both sides get
    ``_x`` (left) / ``_y`` (right) suffixes, as pandas ``merge`` does."""
    if key not in combined.columns:
        return combined
    out = combined
    for ext in externals:
        if key not in ext.columns:
            continue
        overlap = (set(out.columns) & set(ext.columns)) - {key}
        left = out.select(*[F.col(c).alias(f"{c}_x") if c in overlap else F.col(c) for c in out.columns])
        right = ext.select(*[F.col(c).alias(f"{c}_y") if c in overlap else F.col(c) for c in ext.columns])
        out = left.join(right, key, "left")
    return out


def side_by_side(preds: list[DataFrame], key: str = "id", col: str = "y", prefix: str = "y_") -> DataFrame:
    """One column per prediction table, aligned on the key (full outer
    join, so unequal tables are padded with NULL)."""
    parts = []
    for i, p in enumerate(preds):
        if col not in p.columns:
            others = [c for c in p.columns if c != key]
            if len(others) != 1:
                raise ValueError(f"prediction table {i} has no '{col}' column")
            p = p.withColumnRenamed(others[0], col)
        parts.append(p.select(key, F.col(col).alias(f"{prefix}{i}")))
    return reduce(lambda a, b: a.join(b, key, "full_outer"), parts)


def ensemble_mean(preds: list[DataFrame], key: str = "id", col: str = "y") -> DataFrame:
    """Mean of the available predictions per key."""
    wide = side_by_side(preds, key, col)
    cols = [c for c in wide.columns if c != key]
    s = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in cols])
    n = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in cols])
    return wide.select(key, F.try_divide(s, n.cast("double")).alias(col))


def submission(sample: DataFrame, preds: DataFrame, key: str = "id", col: str = "y",
               check: bool = True) -> DataFrame:
    """J03 + E10: the sample's keys with the prediction clipped to [0, 1].

    ``check`` runs one aggregate over the keys of both sides and raises when a
    key is on one side only or has several predictions (the reference
    compares row counts).
    """
    if col not in preds.columns:
        others = [c for c in preds.columns if c != key]
        if len(others) != 1:
            raise ValueError("predictions need a 'y' column or a single unnamed column")
        preds = preds.withColumnRenamed(others[0], col)
    s = sample.select(key).withColumn("_s", F.lit(1))
    p = preds.select(key, col).withColumn("_p", F.lit(1))
    if check:
        one = F.lit(1).cast("long")
        keys = s.select(key, one.alias("s"), (one - 1).alias("p")).unionByName(p.select(key, (one - 1).alias("s"), one.alias("p")))
        bad = (keys.groupBy(key).agg(F.sum("s").alias("s"), F.sum("p").alias("p"))
               .agg(F.count_if(F.col("s") == 0).alias("a"), F.count_if(F.col("p") == 0).alias("b"), F.count_if(F.col("p") > 1).alias("c"))
               .first())
        if bad["a"] or bad["b"] or bad["c"]:
            raise ValueError(f"row mismatch: {bad['b']} sample keys without prediction, "
                             f"{bad['a']} predictions without sample key, {bad['c']} keys with several predictions")
    clipped = clip(F.col(col).cast("double"), 0.0, 1.0)
    return sample.drop(col).join(p.select(key, clipped.alias(col)), key, "inner")
