"""Feature transforms: T05c, T09-T13 and the chain T15.

Caps, logs and interactions are projections. Rare grouping and quantile
bins fit small parameter sets (rare values per column, bin edges) with
aggregate jobs, then apply them as literal expressions.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.exprs import (case_by, clip_upper, div_zero_as_null, div_zero_as_one,
                                     sorted_bucket, unpivot)
from tessera.functions.quantiles import column_quantiles, quantiles
from tessera.operators.clean import _replace, apply_cap, apply_log1p, fit_cap
from tessera.roles import Roles

RARE_MAX_UNIQUE = 50
RARE_CODE = -1.0
BIN_COLS = ("balance", "duration", "campaign")
CAP_COLS = ("duration", "campaign")


# ---------------------------------------------------------------- T05c

def fit_cap_by_group(df: DataFrame, cols: list[str], q: float, group: str) -> dict:
    """Upper caps per group value (e.g. per fold's training part)."""
    got = quantiles(df, {c: [q] for c in cols}, group_cols=[group])
    return {(g[0], c): v for (g, c, _), v in got.items()}


def apply_cap_by_group(df: DataFrame, caps: dict, group: str) -> DataFrame:
    cols = sorted({c for _, c in caps})
    exprs = {}
    for c in cols:
        cap = case_by(F.col(group), {g: v for (g, cc), v in caps.items() if cc == c}, None)
        x = F.col(c).cast("double")
        exprs[c] = F.when(x.isNull() | F.isnan(x) | cap.isNull(), x).otherwise(F.least(x, cap))
    return _replace(df, exprs)


# ---------------------------------------------------------------- T09

def fit_rare(df: DataFrame, threshold: float | None, roles: Roles = Roles(),
             max_unique: int = RARE_MAX_UNIQUE, cols=None) -> dict[str, list[str]]:
    """Columns with at most ``max_unique`` distinct non-null values; a value
    is rare when count / all rows (NULLs included) <= threshold.

    One ``groupBy(feature, value)`` (partial aggregation) over the long
    table with NULL cells kept, so each feature's counts also sum to the
    row count. A scan before it excludes columns by distinct-count sketches. The value counts are kept
    (memory, spilling to disk) for the per-feature stats job and the rare
    rows job; only (column, rare value) pairs -- at most max_unique per
    column -- reach the driver.
    """
    if threshold is None or not (0.0 < threshold < 1.0):
        return {}
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in roles.reserved]
    if not cols:
        return {}
    # columns that surely have too many values stay out of the shuffle: a sketch of 4,096 registers is off by a few percent
    row = df.agg(*[F.hll_sketch_estimate(F.hll_sketch_agg(F.col(c).cast("string"))).alias(f"d{i}") for i, c in enumerate(cols)]).first()
    cols = [c for i, c in enumerate(cols) if (row[f"d{i}"] or 0) <= 2 * max_unique]
    if not cols:
        return {}
    long = unpivot(df, cols, cast="string", drop_nulls=False)
    vc = (long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
          .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        stats = {r["feature"]: (r["nd"], r["total"]) for r in
                 vc.groupBy("feature").agg(F.count("value").alias("nd"), F.sum("n").alias("total")).collect()}
        small = [c for c, (k, t) in stats.items() if k <= max_unique and t > 0]
        if not small:
            return {}
        total = case_by(F.col("feature"), {c: stats[c][1] for c in small})
        rows = (vc.where(F.col("feature").isin(*small) & F.col("value").isNotNull()
                         & (F.col("n") / total <= F.lit(threshold)))
                .select("feature", "value").collect())
    finally:
        vc.unpersist()
    out: dict[str, list[str]] = {}
    for r in rows:
        out.setdefault(r["feature"], []).append(r["value"])
    return out


def apply_rare(df: DataFrame, rare: dict, code: float = RARE_CODE) -> DataFrame:
    """Replace rare values by ``code`` cast to the column's type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = {}
    for c, vals in rare.items():
        if c not in types:
            continue
        dt = types[c]
        hit = F.col(c).cast("string").isin(*vals)
        lit = F.lit(str(code)) if isinstance(dt, T.StringType) else F.lit(code).cast(dt)
        exprs[c] = F.when(hit, lit).otherwise(F.col(c))
    return _replace(df, exprs)


# ---------------------------------------------------------------- T10

def fit_qbins(df: DataFrame, cols: list[str], q: int) -> dict[str, list[float]]:
    """Distinct exact quantiles at i/q, i = 0..q (pandas qcut, duplicates
    dropped)."""
    cols = [c for c in cols if c in df.columns]
    if not cols or q is None or q < 2:
        return {}
    ps = [i / q for i in range(q + 1)]
    got = column_quantiles(df, cols, ps)
    return {c: sorted({v for v in vs if v is not None}) for c, vs in got.items()}


def apply_qbins(df: DataFrame, edges: dict, suffix: str = "_qbin") -> DataFrame:
    """Bins right-closed, lowest edge included: code = max(#edges < x - 1, 0);
    NULL outside [first, last] edge and when fewer than two edges."""
    new = {}
    for c, e in edges.items():
        x = F.col(c).cast("double")
        if len(e) < 2:
            b = F.lit(None).cast("int")
        else:
            n_below = sorted_bucket(x, e)
            b = F.when(x.isNull() | (x < F.lit(e[0])) | (x > F.lit(e[-1])), F.lit(None)) \
                .otherwise(F.greatest(n_below - 1, F.lit(0))).cast("int")
        new[f"{c}{suffix}"] = b
    # one projection for all columns (one analysis of the plan, not one per column)
    return df.withColumns(new) if new else df


# ---------------------------------------------------------------- T11-T13

def add_interactions(df: DataFrame, add_all: bool = False) -> DataFrame:
    """T11 always (when its inputs exist); T12, T13 only with ``add_all``
    (survey Q13)."""
    cols = set(df.columns)
    new = {}
    if {"duration", "campaign"} <= cols:
        new["duration_per_campaign"] = div_zero_as_one(F.col("duration").cast("double"),
                                                       F.col("campaign").cast("double"))
    if add_all and {"duration", "contact"} <= cols:
        new["duration_x_contact"] = F.col("duration").cast("double") * F.col("contact").cast("double")
    if add_all and {"balance", "age"} <= cols:
        new["balance_over_age"] = div_zero_as_null(F.col("balance").cast("double"), F.col("age").cast("double"))
    return df.withColumns(new) if new else df


# ---------------------------------------------------------------- T15

def engineer(df: DataFrame, roles: Roles = Roles(), cap_pct: float | None = None,
             log1p_balance: bool = False, rare_threshold: float | None = None,
             rare_max_unique: int = RARE_MAX_UNIQUE, rare_code: float = RARE_CODE,
             quantile_bins: int | None = None, bin_cols=BIN_COLS, add_all_interactions: bool = False) -> DataFrame:
    """Cap -> log -> rare -> bins -> interactions on one table, each
    step fitted on the output of the previous one (whole table, as the
    reference does on the combined train+test table)."""
    x = apply_cap(df, fit_cap(df, [c for c in CAP_COLS if c in df.columns], cap_pct))
    if log1p_balance:
        x = apply_log1p(x, ["balance"])
    x = apply_rare(x, fit_rare(x, rare_threshold, roles, rare_max_unique), rare_code)
    if quantile_bins:
        x = apply_qbins(x, fit_qbins(x, list(bin_cols), quantile_bins))
    return add_interactions(x, add_all_interactions)


_ = (clip_upper,)
