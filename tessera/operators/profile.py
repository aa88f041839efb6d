"""Quality checks and descriptive profiles: A01-A16, P10, P11.

Many columns and one statistic is one ``agg``; per-value work is an
``unpivot`` to (feature, value) and a ``groupBy`` with partial aggregation.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import case_by, finite_table, unpivot
from tessera.functions.quantiles import column_quantiles
from tessera.roles import Roles

IQR_K = 1.5
HIST_BINS = 50
TOP_VALUES = 10
TOP_PAIRS = 15
TOPK_SPREAD = 256   # hash buckets for the two-level top-k
PAIR_BLOCK = 60     # column pairs whose moments leave a task in one batch


def _numeric(df: DataFrame, roles: Roles, cols=None) -> list[str]:
    return list(cols) if cols is not None else roles.numeric_cols(df)


def _stack(row_df: DataFrame, items: list[tuple[str, str, str]], names=("check", "column_name", "value")) -> DataFrame:
    """(check, column, expr-col) triples of a one-row frame -> long rows."""
    if not items:
        return row_df.sparkSession.createDataFrame([], f"{names[0]} string, {names[1]} string, {names[2]} double")
    arr = F.array(*[F.struct(F.lit(chk).alias(names[0]), F.lit(c).cast("string").alias(names[1]),
                             F.col(src).cast("double").alias(names[2])) for chk, c, src in items])
    return row_df.select(F.explode(arr).alias("_s")).select("_s.*")


# ---------------------------------------------------------------- A01 / A07

def missing_counts(df: DataFrame, cols=None, only_positive: bool = True) -> DataFrame:
    """(column_name, missing_count) for columns with missing values."""
    cols = list(cols or df.columns)
    row = finite_table(df).agg(*[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)])
    out = _stack(row, [("missing", c, f"_m{i}") for i, c in enumerate(cols)]) \
        .select("column_name", F.col("value").cast("long").alias("missing_count"))
    return out.where(F.col("missing_count") > 0) if only_positive else out


def missingness(df: DataFrame, cols=None) -> DataFrame:
    """Count and share missing for every column, largest first."""
    cols = list(cols or df.columns)
    row = finite_table(df).agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)])
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_m{i}").alias("missing_count"))
                    for i, c in enumerate(cols)])
    return (row.select("_n", F.explode(arr).alias("s"))
            .select("s.column_name", "s.missing_count",
                    F.try_divide(F.col("s.missing_count").cast("double"), F.col("_n")).alias("missing_pct"))
            .orderBy(F.desc("missing_pct"), "column_name"))


# ---------------------------------------------------------------- A02

def duplicate_rows(df: DataFrame, cols=None) -> DataFrame:
    """Rows equal to an earlier row (NULLs compare equal).

    ``groupBy(all columns)`` pre-aggregates map-side, so a value shared by a
    third of the table is one row per map task before the shuffle.
    """
    cols = list(cols or df.columns)
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
            .agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("duplicate_rows")))


# ---------------------------------------------------------------- A03

def column_types(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """(position, column_name, dtype, role) from the schema."""
    from tessera.roles import role_table
    roles_ = dict(role_table(df, roles))
    rows = [(i + 1, f.name, f.dataType.simpleString(), roles_[f.name]) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, dtype string, role string")


# ---------------------------------------------------------------- A04 / A15

def class_distribution(df: DataFrame, label: str = "y") -> DataFrame:
    """(label, n, pct). The window runs on the reduced two-row table."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(label, "n", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("pct"))


def class_weight(df: DataFrame, label: str = "y") -> DataFrame:
    """Negatives / positives, 1.0 when there are no positives."""
    y = F.col(label).cast("int")
    pos, neg = F.count_if(y == 1), F.count_if(y == 0)
    return df.agg(F.when(pos > 0, neg / pos).otherwise(F.lit(1.0)).alias("class_weight"))


def class_weight_value(df: DataFrame, label: str = "y") -> float:
    return float(class_weight(df, label).first()["class_weight"])


# ---------------------------------------------------------------- A05 / P10

def iqr_bounds(df: DataFrame, cols: list[str], k: float = IQR_K) -> dict[str, tuple]:
    """Fit: (lower, upper) = (Q1 - k IQR, Q3 + k IQR) per column (exact; the
    quantiles skip what is missing, NaN and infinities included)."""
    q = column_quantiles(df, cols, [0.25, 0.75])
    out = {}
    for c, (q1, q3) in q.items():
        if q1 is None:
            out[c] = (None, None)
        else:
            iqr = q3 - q1
            out[c] = (q1 - k * iqr, q3 + k * iqr)
    return out


def outlier_flag(c: str, lo, hi):
    """P10: strict comparison against fitted bounds."""
    if lo is None:
        return F.lit(False)
    return (F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi))


def iqr_outlier_counts(df: DataFrame, roles: Roles = Roles(), cols=None, k: float = IQR_K) -> DataFrame:
    """(column_name, outlier_count) per numeric non-label column."""
    df = finite_table(df)
    cols = _numeric(df, roles, cols)
    b = iqr_bounds(df, cols, k)
    row = df.agg(*[F.count_if(outlier_flag(c, *b[c])).alias(f"_o{i}") for i, c in enumerate(cols)])
    return _stack(row, [("outliers", c, f"_o{i}") for i, c in enumerate(cols)]) \
        .select("column_name", F.col("value").cast("long").alias("outlier_count"))


# ---------------------------------------------------------------- A16

def validation_table(df: DataFrame, roles: Roles = Roles(), k: float = IQR_K) -> DataFrame:
    """Every check as (check, column_name, value).

    One scan for missing counts, total and outliers; one shuffle for
    duplicates; one tiny aggregate for the class distribution.
    """
    df = finite_table(df)
    cols = df.columns
    num = roles.numeric_cols(df)
    b = iqr_bounds(df, num, k)
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)]
    aggs += [F.count_if(outlier_flag(c, *b[c])).alias(f"_o{i}") for i, c in enumerate(num)]
    row = df.agg(*aggs).withColumn("_mt", sum(F.col(f"_m{i}") for i in range(len(cols))))
    items = [("missing_values", c, f"_m{i}") for i, c in enumerate(cols)]
    items += [("outliers", c, f"_o{i}") for i, c in enumerate(num)]
    items += [("total_missing", None, "_mt"), ("row_count", None, "_n")]
    long = _stack(row, items).where((F.col("check") != "missing_values") | (F.col("value") > 0))
    dup = duplicate_rows(df).select(F.lit("duplicates").alias("check"), F.lit(None).cast("string").alias("column_name"),
                                    F.col("duplicate_rows").cast("double").alias("value"))
    parts = [long, dup]
    if roles.label and roles.label in df.columns:
        parts.append(df.groupBy(roles.label).agg(F.count(F.lit(1)).cast("double").alias("value"))
                     .select(F.lit("target_distribution").alias("check"),
                             F.col(roles.label).cast("string").alias("column_name"), "value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- A06

def describe(df: DataFrame, roles: Roles = Roles(), cols=None) -> DataFrame:
    """Count, unique, top, freq, mean, std (sample), min, quartiles, max.

    Numeric columns get the numeric statistics, text columns the counting
    ones (as pandas ``describe(include='all')``). Exact quartiles.
    """
    df = finite_table(df)
    cols = list(cols or df.columns)
    num = [c for c in cols if c in set(roles.numeric_cols(df)) or c == roles.label or c == roles.key]
    num = [c for c in cols if c in num]
    txt = [f.name for f in df.schema.fields if f.name in cols and f.name not in num
           and f.dataType.simpleString() == "string"]
    spark = df.sparkSession
    parts = []
    if num:
        aggs = []
        for i, c in enumerate(num):
            x = F.col(c).cast("double")
            aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"a{i}"), F.stddev_samp(x).alias(f"s{i}"),
                     F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        row = df.agg(*aggs)
        q = column_quantiles(df, num, [0.25, 0.5, 0.75])
        arr = F.array(*[F.struct(
            F.lit(c).alias("column_name"), F.col(f"n{i}").alias("count"),
            F.lit(None).cast("long").alias("unique"), F.lit(None).cast("string").alias("top"),
            F.lit(None).cast("long").alias("freq"), F.col(f"a{i}").alias("mean"), F.col(f"s{i}").alias("std"),
            F.col(f"lo{i}").alias("min"), F.lit(q[c][0]).cast("double").alias("q25"),
            F.lit(q[c][1]).cast("double").alias("q50"), F.lit(q[c][2]).cast("double").alias("q75"),
            F.col(f"hi{i}").alias("max")) for i, c in enumerate(num)])
        parts.append(row.select(F.explode(arr).alias("s")).select("s.*"))
    if txt:
        long = unpivot(df, txt, cast="string")
        vc = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
        agg = vc.groupBy("feature").agg(
            F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
            F.min(F.struct((-F.col("n")).alias("nn"), F.col("value").alias("v"))).alias("w"))
        present = agg.select(
            F.col("feature").alias("column_name"), F.col("count"), F.col("unique"),
            F.col("w.v").alias("top"), (-F.col("w.nn")).alias("freq"))
        allc = spark.createDataFrame([(c,) for c in txt], "column_name string")
        t = (allc.join(present, "column_name", "left")
             .select("column_name", F.coalesce("count", F.lit(0)).cast("long").alias("count"),
                     F.coalesce("unique", F.lit(0)).cast("long").alias("unique"), "top",
                     F.col("freq").cast("long").alias("freq"),
                     *[F.lit(None).cast("double").alias(n) for n in
                       ("mean", "std", "min", "q25", "q50", "q75", "max")]))
        parts.append(t)
    if not parts:
        raise ValueError("nothing to describe")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- A08 / A11 / P11

def _pair_moments(pairs: list[tuple[int, int, int]], block: int):
    """For Arrow batches of double columns and (number, column a, column b): of the rows where both are given their count,
    means, and sums of products and squares around the means. Values are taken from the first one before their mean, so
    a constant has no spread at all."""
    def run(batches):
        total = np.zeros((len(pairs), 6))

        def centred(v):
            v = v - v[0]
            mean = v.mean()
            return v - mean, mean
        with np.errstate(all="ignore"):
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = [col.to_numpy(zero_copy_only=False) for col in batch.columns]
                given = [None if not col.null_count else np.asarray(col.is_valid()) for col in batch.columns]
                whole = [(*centred(v), v[0]) if g is None else None for v, g in zip(x, given)]
                for at, (_, i, j) in enumerate(pairs):
                    if given[i] is None and given[j] is None:
                        (a, ma, a0), (b, mb, b0) = whole[i], whole[j]
                    else:
                        both = given[j] if given[i] is None else given[i] if given[j] is None else given[i] & given[j]
                        if not both.any():
                            continue
                        va, vb = x[i][both], x[j][both]
                        (a, ma), a0, (b, mb), b0 = centred(va), va[0], centred(vb), vb[0]
                    n, at_a, at_b, c, sa, sb = total[at]
                    more, da, db = len(a), a0 + ma - at_a, b0 + mb - at_b
                    share = more / (n + more)
                    total[at] = (n + more, at_a + da * share, at_b + db * share, c + a @ b + da * db * n * share,
                                 sa + a @ a + da * da * n * share, sb + b @ b + db * db * n * share)
        seen = np.flatnonzero(total[:, 0])
        for start in range(0, len(seen), block):
            these = seen[start:start + block]
            yield pa.record_batch([pa.array([pairs[at][0] for at in these], pa.int32()), *map(pa.array, total[these].T.copy())],
                                  ["_k", "n", "ma", "mb", "c", "sa", "sb"])
    return run


def _merged_moments(x, y):
    """The moments of the rows of two parts together."""
    n = x["n"] + y["n"]
    da, db, share = y["ma"] - x["ma"], y["mb"] - x["mb"], y["n"] / n
    return F.struct(n.alias("n"), (x["ma"] + da * share).alias("ma"), (x["mb"] + db * share).alias("mb"),
                    (x["c"] + y["c"] + da * db * x["n"] * share).alias("c"), (x["sa"] + y["sa"] + da * da * x["n"] * share).alias("sa"),
                    (x["sb"] + y["sb"] + db * db * x["n"] * share).alias("sb"))


def correlation_pairs(df: DataFrame, cols: list[str], upper_only: bool = False,
                      include_diagonal: bool = True) -> DataFrame:
    """Pearson r on pairwise-complete rows, as (feature_a, feature_b,
    pos_a, pos_b, corr); ``pos_a < pos_b`` is the strict upper triangle.

    Tasks add up the moments of all pairs batch by batch (:func:`_pair_moments`) in one
    scan, one row a task and pair is merged; rows are not expanded.
    ``corr`` raises under ANSI on a constant column, so
    r = covar_pop / (sd_a * sd_b), NULL when undefined.
    """
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    if not pairs:
        return df.sparkSession.createDataFrame(
            [], "feature_a string, feature_b string, pos_a int, pos_b int, corr double")
    x = finite_table(df.select(*cols)).select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    need = [(k, i, j) for k, (i, j) in enumerate(pairs) if include_diagonal or i != j]
    parts = x.mapInArrow(_pair_moments(need, PAIR_BLOCK), "_k int, n double, ma double, mb double, c double, sa double, sb double")
    m = F.aggregate(F.array_sort(F.collect_list(F.struct("n", "ma", "mb", "c", "sa", "sb"))),
                    F.struct(*[F.lit(0.0).alias(v) for v in ("n", "ma", "mb", "c", "sa", "sb")]), _merged_moments)
    st = (parts.groupBy("_k").agg(m.alias("m"))
          .select("_k", (F.col("m.c") / F.col("m.n")).alias("c"), F.sqrt(F.col("m.sa") / F.col("m.n")).alias("sa"),
                  F.sqrt(F.col("m.sb") / F.col("m.n")).alias("sb")))
    r = F.try_divide(F.col("c"), F.col("sa") * F.col("sb"))
    r = F.when(F.abs(r) < F.lit(float("inf")), F.least(F.greatest(r, F.lit(-1.0)), F.lit(1.0)))
    meta_rows = []
    for k, (i, j) in enumerate(pairs):
        if i == j and not include_diagonal:
            continue
        meta_rows.append((k, cols[i], cols[j], i, j))
        if not upper_only and i != j:
            meta_rows.append((k, cols[j], cols[i], j, i))
    # pairs x 2 rows: bounded by the schema width
    meta = df.sparkSession.createDataFrame(meta_rows, "_k int, feature_a string, feature_b string, pos_a int, pos_b int")
    # pairs with no complete row still appear, with NULL r
    return (meta.join(F.broadcast(st.select("_k", r.alias("corr"))), "_k", "left")
            .select("feature_a", "feature_b", "pos_a", "pos_b", "corr"))


def top_correlated_pairs(df: DataFrame, cols: list[str], k: int = TOP_PAIRS) -> DataFrame:
    """Strict upper triangle ranked by |r|, top k."""
    p = correlation_pairs(df, cols, upper_only=True, include_diagonal=False)
    return (p.where(F.col("corr").isNotNull())
            .select("feature_a", "feature_b", "corr", F.abs("corr").alias("corr_abs"))
            .orderBy(F.desc("corr_abs"), "feature_a", "feature_b").limit(k))


def high_correlation(df: DataFrame, cols: list[str], threshold: float = 0.9) -> DataFrame:
    """Upper-triangle pairs with |r| > threshold."""
    p = correlation_pairs(df, cols, upper_only=True, include_diagonal=False)
    return p.where(F.abs("corr") > threshold).select("feature_a", "feature_b", "corr")


# ---------------------------------------------------------------- A09

def top_values(df: DataFrame, cols: list[str], k: int = TOP_VALUES) -> DataFrame:
    """K most frequent values per column (ties -> smaller value).

    Two-level top-k: best k inside each (column, hash bucket of value), then
    best k of those; no window ever sees more than k x buckets rows of a
    column, however many distinct values it has.
    """
    long = unpivot(df, cols, cast="string")
    vc = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc("value")]
    w1 = Window.partitionBy("feature", (F.abs(F.xxhash64("value")) % TOPK_SPREAD)).orderBy(*order)
    local = vc.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= k).drop("_r")
    w2 = Window.partitionBy("feature").orderBy(*order)
    return (local.withColumn("rank", F.row_number().over(w2).cast("long")).where(F.col("rank") <= k)
            .select(F.col("feature").alias("column_name"), "rank", "value", F.col("n").alias("count")))


# ---------------------------------------------------------------- A10

def skewness(df: DataFrame, cols: list[str]) -> DataFrame:
    """A10: bias-adjusted sample skewness (pandas / DuckDB), largest first."""
    df = finite_table(df, cols)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.skewness(x).alias(f"g{i}"), F.count(x).alias(f"n{i}")]
    row = df.agg(*aggs)
    structs = []
    for i, c in enumerate(cols):
        n = F.col(f"n{i}").cast("double")
        adj = F.when(n > 2, F.col(f"g{i}") * F.sqrt(n * (n - 1)) / (n - 2))
        structs.append(F.struct(F.lit(c).alias("column_name"), adj.alias("skewness")))
    return (row.select(F.explode(F.array(*structs)).alias("s")).select("s.*")
            .orderBy(F.desc("skewness"), "column_name"))


# ---------------------------------------------------------------- A12

def histogram(df: DataFrame, cols: list[str], bins: int = HIST_BINS) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed, non-empty
    bins as (column_name, bin, bin_lo, bin_hi, count)."""
    df = finite_table(df, cols)
    row = df.agg(*[F.min(F.col(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(cols)],
                 *[F.max(F.col(c).cast("double")).alias(f"hi{i}") for i, c in enumerate(cols)]).first()
    rng = {}
    for i, c in enumerate(cols):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        if lo is None:
            continue
        if lo == hi:     # numpy widens a zero range by 0.5 each side
            lo, hi = lo - 0.5, hi + 0.5
        rng[c] = (lo, hi)
    if not rng:
        return df.sparkSession.createDataFrame(
            [], "column_name string, bin int, bin_lo double, bin_hi double, count long")
    long = unpivot(df, list(rng), cast="double")
    # The fitted ranges join as a table of one row per column (bounded by
    # the schema, so broadcast). A per-feature CASE used twice in the same
    # projection over the unpivot's Expand trips Spark's subexpression
    # codegen, which then falls back to the interpreted path.
    rng_df = df.sparkSession.createDataFrame([(c, float(v[0]), float(v[1])) for c, v in rng.items()],
                                             "feature string, _lo double, _hi double")
    lo, hi = F.col("_lo"), F.col("_hi")
    w = (hi - lo) / F.lit(bins)
    b = F.least(F.floor((F.col("value") - lo) / w).cast("int"), F.lit(bins - 1))
    return (long.join(F.broadcast(rng_df), "feature")
            .groupBy("feature", "_lo", "_hi", b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
            .select(F.col("feature").alias("column_name"), "bin",
                    (lo + F.col("bin") * w).alias("bin_lo"), (lo + (F.col("bin") + 1) * w).alias("bin_hi"),
                    "count"))


# ---------------------------------------------------------------- A13

KDE_POINTS = 200
KDE_CUT = 3.0


def density(df: DataFrame, cols: list[str], by: str | None = None, points: int = KDE_POINTS) -> DataFrame:
    """Gaussian kernel density on a 200-point grid per column
    (and per class of ``by``, each normalised on its own rows).

    Scott bandwidth n^(-1/5) * sample sd; grid from min - 3 bw to max + 3 bw.
    Exact: one pass with one sum per grid point (no row blow-up).
    """
    df = finite_table(df, cols)
    gcols = [by] if by else []
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    stats = (df.groupBy(*gcols).agg(*aggs) if gcols else df.agg(*aggs)).collect()
    params = {}
    for r in stats:
        g = r[by] if by else None
        for i, c in enumerate(cols):
            n, s, lo, hi = r[f"n{i}"], r[f"s{i}"], r[f"lo{i}"], r[f"hi{i}"]
            if not n or n < 2 or not s:
                continue
            bw = s * n ** (-1 / 5)
            a, z = lo - KDE_CUT * bw, hi + KDE_CUT * bw
            params[(g, c)] = (a, (z - a) / (points - 1), bw, n)
    if not params:
        return df.sparkSession.createDataFrame(
            [], f"{'' if not by else by + ' int, '}column_name string, point int, x double, density double")
    long = unpivot(df, cols, ids=gcols, cast="double")
    keyexpr = F.concat_ws("\u0001", *( [F.col(by).cast("string")] if by else []), F.col("feature"))

    def kstr(g, c):
        return "\u0001".join(([str(g)] if by else []) + [c])
    a = case_by(keyexpr, {kstr(g, c): v[0] for (g, c), v in params.items()})
    st = case_by(keyexpr, {kstr(g, c): v[1] for (g, c), v in params.items()})
    bw = case_by(keyexpr, {kstr(g, c): v[2] for (g, c), v in params.items()})
    long = long.select(*gcols, "feature", "value", a.alias("_a"), st.alias("_st"), bw.alias("_bw")) \
        .where(F.col("_bw").isNotNull())
    sums = [F.sum(F.exp(F.lit(-0.5) * F.pow((F.col("_a") + F.lit(j) * F.col("_st") - F.col("value"))
                                            / F.col("_bw"), 2))).alias(f"d{j}") for j in range(points)]
    agg = long.groupBy(*gcols, "feature").agg(F.count(F.lit(1)).alias("_n"), F.first("_a").alias("_a"),
                                             F.first("_st").alias("_st"), F.first("_bw").alias("_bw"), *sums)
    arr = F.array(*[F.struct(F.lit(j).alias("point"), F.col(f"d{j}").alias("d")) for j in range(points)])
    norm = F.lit(1.0 / math.sqrt(2 * math.pi))
    return (agg.select(*gcols, "feature", "_n", "_a", "_st", "_bw", F.explode(arr).alias("p"))
            .select(*gcols, F.col("feature").alias("column_name"), F.col("p.point").cast("long").alias("point"),
                    (F.col("_a") + F.col("p.point") * F.col("_st")).alias("x"),
                    (F.col("p.d") * norm / (F.col("_n") * F.col("_bw"))).alias("density")))


KDE_CELLS = 512      # cells a bandwidth


def density_binned(df: DataFrame, cols: list[str], by: str | None = None, points: int = KDE_POINTS,
                   cells: int = KDE_CELLS) -> DataFrame:
    """A13 with linear binning: the curve of ``density``, whose work a row does not depend on ``points``.

    Each value is split over the two cell borders around it by its distance to
    them, so a cell is its rows and the sum of their positions inside it: one
    grouped aggregate. Kernels are evaluated at the borders of occupied cells
    (at most range / bandwidth x ``cells`` a curve, however many rows). Linear
    binning is off by at most 1 / (8 cells^2) of the kernel's curvature: 5e-7 of
    a density of one bandwidth. Nothing is collected; columns with fewer than
    two values or one distinct value have no curve; rows with a null class are
    a class of their own."""
    df = finite_table(df, cols)
    gcols = [by] if by else []
    # a fixed name: ``by`` may be called like one of the columns below
    klass = F.col(by) if by else F.lit(0)
    long = unpivot(df.select(klass.alias("_class"), *cols), cols, ids=["_class"], cast="double")
    stats = (long.groupBy("_class", "feature")
             .agg(F.count("value").alias("_n"), F.stddev_samp("value").alias("_s"), F.min("value").alias("_lo"),
                  F.max("value").alias("_hi")).where("_n > 1 AND _s > 0")
             .withColumn("_bw", F.col("_s") * F.pow("_n", F.lit(-0.2)))
             .select(F.col("_class").alias("_c"), F.col("feature").alias("_f"), "_n", "_lo", "_bw",
                     (F.col("_lo") - KDE_CUT * F.col("_bw")).alias("_a"), (F.col("_hi") + KDE_CUT * F.col("_bw")).alias("_z"))
             .withColumn("_st", (F.col("_z") - F.col("_a")) / (points - 1)))
    same = F.col("_class").eqNullSafe(F.col("_c")) & (F.col("feature") == F.col("_f"))
    at = (F.col("value") - F.col("_lo")) / F.col("_bw") * cells
    binned = (long.join(stats.select("_c", "_f", "_lo", "_bw"), same).select("_class", "feature", at.alias("_at"))
              .groupBy("_class", "feature", F.floor("_at").alias("_cell"))
              .agg(F.count(F.lit(1)).alias("_rows"), F.sum(F.col("_at") - F.floor("_at")).alias("_up")))

    def kernel(border):
        here = F.col("_lo") + border * F.col("_bw") / cells
        return F.exp(F.lit(-0.5) * F.pow((F.col("_x") - here) / F.col("_bw"), F.lit(2)))
    part = (F.col("_rows") - F.col("_up")) * kernel(F.col("_cell")) + F.col("_up") * kernel(F.col("_cell") + 1)
    norm = F.lit(math.sqrt(2 * math.pi))
    sums = (binned.join(stats, same).withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
            .withColumn("_x", F.col("_a") + F.col("point") * F.col("_st"))
            .groupBy("_class", "feature", "point", "_x", "_n", "_bw").agg(F.sum(part).alias("_d")))
    return sums.select(*[F.col("_class").alias(g) for g in gcols], F.col("feature").alias("column_name"),
                       F.col("point").cast("long").alias("point"), F.col("_x").alias("x"),
                       (F.col("_d") / (F.col("_n") * F.col("_bw") * norm)).alias("density"))


# ---------------------------------------------------------------- A14

PREVIEW_ROWS = 5


def shape(df: DataFrame) -> DataFrame:
    """Row and column counts."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def preview(df: DataFrame, key: str = "id", n: int = PREVIEW_ROWS) -> DataFrame:
    """The first n rows by key (rows have no position here)."""
    return df.orderBy(key).limit(n)
