"""Cleaning transforms: T01-T08 and the chain T14.

Each operator is ``fit(df, ...) -> params`` (a small dict of columns x
statistics, computed by aggregate jobs) and ``apply(df, params) -> df`` (a
lazy projection with the statistics as literals, so it stays inside
whole-stage codegen). ``params_frame`` turns any params dict into the
(operator, column_name, stat, value) table that S10 persists.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import clip, clip_upper, finite_table, unpivot
from tessera.functions.quantiles import column_quantiles, cumulative, filled_order_stats, medians, modes
from tessera.operators.profile import IQR_K, iqr_bounds
from tessera.roles import Roles

# What pandas' ``astype(str)`` makes of a missing value, which
# the reference's label encoder then treats as an ordinary category.
NULL_TEXT = "nan"


def _replace(df: DataFrame, exprs: dict) -> DataFrame:
    """Replace the listed columns in place, keeping column order; what is
    missing by the entry rule is NULL in them."""
    df = finite_table(df, list(exprs))
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- T01 / T03

def fit_median(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    return medians(df, cols)


def apply_median(df: DataFrame, med: dict) -> DataFrame:
    """Median fill; filled columns become double (as SimpleImputer)."""
    return _replace(df, {c: F.coalesce(F.col(c).cast("double"), F.lit(v).cast("double"))
                         for c, v in med.items() if c in df.columns})


def fill_median_inline(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fill with the column's own median just before scoring."""
    return apply_median(df, fit_median(df, cols))


# ---------------------------------------------------------------- T02

def fit_mode(df: DataFrame, cols: list[str]) -> dict:
    return modes(df, cols)


def apply_mode(df: DataFrame, mode: dict) -> DataFrame:
    return _replace(df, {c: F.coalesce(F.col(c), F.lit(v)) for c, v in mode.items() if c in df.columns})


# ---------------------------------------------------------------- T04

def fit_iqr(df: DataFrame, cols: list[str], k: float = 1.5) -> dict[str, tuple]:
    return iqr_bounds(df, cols, k)


def apply_iqr(df: DataFrame, bounds: dict) -> DataFrame:
    """Cap into [lo, hi]; NULL stays NULL; result double."""
    return _replace(df, {c: clip(F.col(c).cast("double"), lo, hi)
                         for c, (lo, hi) in bounds.items() if c in df.columns and lo is not None})


# ---------------------------------------------------------------- T05 (whole-table and train-fit caps)

def fit_cap(df: DataFrame, cols: list[str], q: float | None) -> dict[str, float]:
    """Upper cap at the q-quantile; inactive unless 0 < q < 1."""
    if q is None or not (0.0 < q < 1.0):
        return {}
    cols = [c for c in cols if c in df.columns]
    return {c: v[0] for c, v in column_quantiles(df, cols, [q]).items()}


def apply_cap(df: DataFrame, caps: dict) -> DataFrame:
    return _replace(df, {c: clip_upper(F.col(c), v) for c, v in caps.items() if c in df.columns})


# ---------------------------------------------------------------- T06

def apply_log1p(df: DataFrame, cols: list[str]) -> DataFrame:
    """log(1 + x); NULL for x <= -1 (NumPy gives -inf / NaN, survey Q9)."""
    return _replace(df, {c: F.log1p(F.col(c).cast("double")) for c in cols if c in df.columns})


# ---------------------------------------------------------------- T07

@dataclass
class OrdinalCodes:
    """Per column: code = rank of the distinct text in ascending order, as a
    written table (feature, value, code) of any size."""
    columns: list[str] = field(default_factory=list)
    table: DataFrame | None = None


def fit_ordinal(df: DataFrame, cols: list[str]) -> OrdinalCodes:
    """Dictionary per column. Missing text is the class 'nan' (as the
    reference's ``astype(str)``). The codes come from the bucketed running
    count (no window holds a large column) and are written once."""
    if not cols:
        return OrdinalCodes()
    from tessera.session import materialize
    prepared = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(NULL_TEXT)).alias(c) for c in cols])
    cum, _ = cumulative(unpivot(prepared, cols, cast="string").distinct(), ["feature"], "value", {"one": F.count(F.lit(1))})
    return OrdinalCodes(list(cols), materialize(cum.select("feature", "value", F.col("one_before").cast("int").alias("code")), "codes"))


def apply_ordinal(df: DataFrame, codes: OrdinalCodes, unseen: str = "first") -> DataFrame:
    """Unseen text -> code 0 (the first class, survey Q14); ``unseen='null'``
    gives NULL instead; ``'error'`` raises at run time. One join with the
    dictionary per column; the planner broadcasts a small one."""
    def fallback(c):
        if unseen == "first":
            return F.lit(0)
        if unseen == "null":
            return F.lit(None).cast("int")
        return F.raise_error(F.concat(F.lit(f"unseen category in {c}: "), F.col(c)))

    out = df
    for c in codes.columns:
        if c not in df.columns:
            continue
        d = codes.table.where(F.col("feature") == c).select(F.col("value").alias("_v"), F.col("code").alias("_code"))
        out = (out.withColumn("_v", F.coalesce(F.col(c).cast("string"), F.lit(NULL_TEXT)))
               .join(d, "_v", "left")
               .withColumn(c, F.coalesce(F.col("_code"), fallback(c)).cast("int")).drop("_v", "_code"))
    return out.select(*df.columns)


# ---------------------------------------------------------------- T08

def fit_standard(df: DataFrame, cols: list[str]) -> dict[str, tuple]:
    """Mean and population sd (sklearn StandardScaler); sd 0 -> 1."""
    if not cols:
        return {}
    df = finite_table(df, cols)
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        m, s = row[f"m{i}"], row[f"s{i}"]
        out[c] = (m, 1.0 if (s is None or s == 0.0) else s)
    return out


def apply_standard(df: DataFrame, params: dict) -> DataFrame:
    return _replace(df, {c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
                         for c, (m, s) in params.items() if c in df.columns and m is not None})


# ---------------------------------------------------------------- T14

@dataclass
class CleanState:
    numeric: list[str]
    categorical: list[str]
    median: dict
    mode: dict
    iqr: dict
    caps: dict
    log1p: list[str]
    codes: OrdinalCodes
    scale: dict


def fit_clean(train: DataFrame, roles: Roles = Roles(), cap_pct: float | None = None,
              log1p_balance: bool = False, cap_cols=("duration", "campaign"),
              scale_codes: bool = True) -> CleanState:
    """T14 fit: missing -> outliers -> clean -> encode -> scale, each step
    fitted on the output of the previous one, on training rows only."""
    num, cat = roles.numeric_cols(train), roles.categorical_cols(train)
    # Several fit passes read the same rows: keep them (memory, spilling to
    # disk) for the duration of the fit; a lost executor recomputes its part.
    train = finite_table(train).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit_clean(train, num, cat, cap_pct, log1p_balance, cap_cols, scale_codes)
    finally:
        train.unpersist()


def _fit_clean(train, num, cat, cap_pct, log1p_balance, cap_cols, scale_codes) -> CleanState:
    # The text columns' fit (mode, then the dictionary of the filled
    # column) does not depend on the numeric one: submit both at once so
    # their jobs share the cluster.
    from concurrent.futures import ThreadPoolExecutor

    def text_part():
        mode = fit_mode(train, cat)
        return mode, fit_ordinal(apply_mode(train.select(*cat), mode), cat)

    caps_on = [c for c in cap_cols if c in num]
    with ThreadPoolExecutor(max_workers=2) as pool:
        t = pool.submit(text_part)
        med, iqr, caps = fit_numeric_chain(train, num, cap_cols=caps_on, cap_pct=cap_pct)
        mode, codes = t.result()
    x = apply_mode(apply_median(train, med), mode)
    x = apply_iqr(x, iqr)
    x = apply_cap(x, caps)
    logs = ["balance"] if log1p_balance and "balance" in train.columns else []
    x = apply_log1p(x, logs)
    x = apply_ordinal(x, codes)
    scale_cols = num + (cat if scale_codes else [])
    scale = fit_standard(x, scale_cols)
    return CleanState(num, cat, med, mode, iqr, caps, logs, codes, scale)


def _fit_numeric_stepwise(train, num, k=IQR_K, cap_cols=(), cap_pct=None):
    """The chain's numeric fit one step at a time (median; fences on the
    filled values; cap on the clipped values): three quantile passes.
    Kept as the plain statement of what :func:`fit_numeric_chain` computes."""
    med = fit_median(train, num)
    x = apply_median(train, med)
    iqr = fit_iqr(x, num, k)
    caps = fit_cap(apply_iqr(x, iqr), list(cap_cols), cap_pct)
    return med, iqr, caps


def fit_numeric_chain(train: DataFrame, num: list[str], k: float = IQR_K, cap_cols=(),
                      cap_pct: float | None = None) -> tuple[dict, dict, dict]:
    """Median fill -> IQR fences on the filled values -> upper quantile cap
    on the clipped values, all from ONE exact order-statistics pass over
    the original values (:func:`filled_order_stats`) instead of three.
    Clipping is monotone, so the clipped column's order statistics are the
    clips of the filled ones."""
    cap_active = cap_pct is not None and 0.0 < cap_pct < 1.0
    cap_cols = [c for c in cap_cols if c in num] if cap_active else []
    fs = filled_order_stats(train, num, {c: [0.25, 0.75] + ([cap_pct] if c in cap_cols else []) for c in num})
    med, iqr, caps = {}, {}, {}
    for c in num:
        s = fs[c]
        med[c] = s.median
        if s.median is None:
            iqr[c] = (None, None)
            if c in cap_cols:
                caps[c] = None
            continue
        q1, q3 = s.quantile(0.25), s.quantile(0.75)
        lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
        iqr[c] = (lo, hi)
        if c in cap_cols:
            caps[c] = s.quantile(cap_pct, lambda v, lo=lo, hi=hi: max(min(v, hi), lo))
    return med, iqr, caps


def apply_clean(df: DataFrame, st: CleanState, roles: Roles = Roles(), drop_key: bool = False) -> DataFrame:
    """T14 apply: one projection chain; the key is never transformed (Q5)."""
    x = apply_mode(apply_median(df, st.median), st.mode)
    x = apply_iqr(x, st.iqr)
    x = apply_cap(x, st.caps)
    x = apply_log1p(x, st.log1p)
    x = apply_ordinal(x, st.codes)
    x = apply_standard(x, st.scale)
    if drop_key and roles.key in x.columns:
        x = x.drop(roles.key)
    return x


def params_frame(spark, st: CleanState) -> DataFrame:
    """The fitted state as (operator, column_name, stat, value)."""
    rows = []
    for c, v in st.median.items():
        rows.append(("impute_median", c, "median", None if v is None else str(v)))
    for c, v in st.mode.items():
        rows.append(("impute_mode", c, "mode", v))
    for c, (lo, hi) in st.iqr.items():
        rows += [("cap_iqr", c, "lower", str(lo)), ("cap_iqr", c, "upper", str(hi))]
    for c, v in st.caps.items():
        rows.append(("cap_quantile", c, "cap", str(v)))
    for c in st.log1p:
        rows.append(("log1p", c, "apply", "true"))
    for c, (m, s) in st.scale.items():
        rows += [("standardize", c, "mean", str(m)), ("standardize", c, "scale", str(s))]
    for kind, cols in (("numeric", st.numeric), ("categorical", st.categorical)):
        rows += [("roles", c, f"{kind}:{i}", None) for i, c in enumerate(cols)]
    out = spark.createDataFrame(rows, PARAMS_SCHEMA)
    if st.codes.table is None:
        return out
    # a dictionary of any size is a part of the table, not of the driver
    return out.unionByName(st.codes.table.select(
        F.lit("encode_ordinal").alias("operator"), F.col("feature").alias("column_name"),
        F.concat(F.lit("code:"), F.col("code").cast("string")).alias("stat"), "value"))


PARAMS_SCHEMA = "operator string, column_name string, stat string, value string"


def clean_state(params: DataFrame) -> CleanState:
    """S10 read side: the state that :func:`params_frame` wrote. Only the
    dictionaries stay a DataFrame."""
    def number(v):
        return None if v in (None, "None") else float(v)

    codes = params.where("operator = 'encode_ordinal'").select(
        F.col("column_name").alias("feature"), "value", F.expr("substring(stat, 6)").cast("int").alias("code"))
    got: dict[str, dict[str, dict]] = {}
    for r in params.where("operator <> 'encode_ordinal'").collect():      # columns x statistics
        got.setdefault(r["operator"], {}).setdefault(r["column_name"], {})[r["stat"]] = r["value"]
    roles = {(k.split(":")[0], int(k.split(":")[1])): c for c, v in got.get("roles", {}).items() for k in v}
    numeric, categorical = ([c for (k, _), c in sorted(roles.items()) if k == kind] for kind in ("numeric", "categorical"))
    return CleanState(
        numeric, categorical,
        {c: number(v["median"]) for c, v in got.get("impute_median", {}).items()},
        {c: v["mode"] for c, v in got.get("impute_mode", {}).items()},
        {c: (number(v["lower"]), number(v["upper"])) for c, v in got.get("cap_iqr", {}).items()},
        {c: number(v["cap"]) for c, v in got.get("cap_quantile", {}).items()},
        list(got.get("log1p", {})),
        OrdinalCodes(categorical, codes) if categorical else OrdinalCodes(),
        {c: (number(v["mean"]), number(v["scale"])) for c, v in got.get("standardize", {}).items()})
