"""Feature scoring: M01-M03, M07-M09 and the exact ROC AUC E01.

AUC with ties averaged is Mann-Whitney: for each distinct score value,
positives there beat every negative below and tie with the negatives
there. Per (feature, value) counts come from a ``groupBy`` with partial
aggregation; the running count of negatives below each value comes from
the bucketed cumulative kernel, so neither a hot value nor a column with
billions of distinct values lands in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import case_by, finite, unpivot
from tessera.functions.quantiles import cumulative, medians
from tessera.roles import Roles
from tessera.session import materialize

LEAK_HI, LEAK_LO = 0.999, 0.001
MI_BINS = 10
EULER = 0.5772156649015329


def _finite_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[finite(F.col(c), types[c]).alias(c) if c in cols else F.col(c) for c in df.columns])


def auc_long(long: DataFrame, keys: list[str], score: str = "value", label: str = "y",
             nd_hint: dict | None = None) -> DataFrame:
    """Exact ROC AUC per key of a long (keys..., score, label) table; keys
    with one class only are omitted. Returns (keys..., auc)."""
    y = F.col(label).cast("int")
    cum, _ = cumulative(long, keys, score, {"pos": F.sum(y), "neg": F.sum(F.lit(1) - y)}, nd_hint=nd_hint)
    contrib = F.col("pos") * (F.col("neg_before") + F.lit(0.5) * F.col("neg"))
    return (cum.groupBy(*keys)
            .agg(F.sum(contrib).alias("_u"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
            .where((F.col("_p") > 0) & (F.col("_n") > 0))
            .select(*keys, (F.col("_u") / (F.col("_p").cast("double") * F.col("_n"))).alias("auc")))


def auc_of_counts(counts: DataFrame, keys: list[str], score: str = "value") -> DataFrame:
    """Exact AUC per key of a (keys..., score, pos, neg) table."""
    cum, _ = cumulative(counts, keys, score, {"pos": F.sum("pos"), "neg": F.sum("neg")})
    contrib = F.col("pos") * (F.col("neg_before") + F.lit(0.5) * F.col("neg"))
    return (cum.groupBy(*keys).agg(F.sum(contrib).alias("_u"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
            .where((F.col("_p") > 0) & (F.col("_n") > 0))
            .select(*keys, (F.col("_u") / (F.col("_p").cast("double") * F.col("_n"))).alias("auc")))


def roc_auc(df: DataFrame, label: str = "y", score: str = "p", by: list[str] | tuple = ()) -> DataFrame:
    """Exact AUC of one score column (optionally per group)."""
    long = df.select(*by, F.col(score).cast("double").alias("value"), F.col(label).alias("y")) \
        .where(F.col("value").isNotNull())
    if not by:
        long = long.withColumn("_all", F.lit(1))
        return auc_long(long, ["_all"]).drop("_all")
    return auc_long(long, list(by))


def univariate_auc(df: DataFrame, roles: Roles = Roles(), cols=None, by: list[str] | tuple = ()) -> DataFrame:
    """Per numeric feature, AUC of the median-filled column against the
    label, best first (one-sided order, survey Q17); adds |AUC - 1/2|.
    ``by`` (e.g. a fold column) scores each group separately; the median
    fill is then per group too."""
    cols = list(cols) if cols is not None else roles.numeric_cols(df)
    by = list(by)
    x = _finite_numeric(df.select(*by, *cols, roles.label), cols)
    long = unpivot(x, cols, ids=by + [roles.label], drop_nulls=False)
    from tessera.functions.quantiles import quantiles
    seen: dict = {}
    med = quantiles(x, {c: [0.5] for c in cols}, group_cols=by, stats_out=seen)
    keyexpr = F.concat_ws("\u0001", *[F.col(b).cast("string") for b in by], F.col("feature"))
    mm = {"\u0001".join([str(v) for v in g] + [c]): v for (g, c, _), v in med.items() if v is not None}
    filled = long.withColumn("value", F.coalesce(F.col("value"), case_by(keyexpr, mm, None)))
    filled = filled.where(F.col("value").isNotNull())
    # the fill adds at most one distinct value per key; a key with no
    # values at all is dropped by the filter above
    hint = {kv: s["_nd"] + 1 for kv, s in seen.items()}
    a = auc_long(filled, by + ["feature"], label=roles.label, nd_hint=hint or None)
    return a.select(*by, "feature", "auc", F.abs(F.col("auc") - F.lit(0.5)).alias("auc_dev"))


def fold_caps(folded: DataFrame, cols: list[str], q: float, k: int, fold_col: str = "fold") -> dict:
    """Quantile q of each fold's training part, {(fold, column): cap}. One shuffle of distinct values counts them
    for every training part; rows are not copied."""
    folds = range(1, k + 1)
    x = _finite_numeric(folded.select(fold_col, *cols), cols)
    long = unpivot(x, cols, ids=[fold_col])
    held: list = []
    try:
        cum, stats = cumulative(long, ["feature"], "value", {f"c{f}": F.count(F.when(F.col(fold_col) != f, 1)) for f in folds}, keep=held)
        found = [c for c in cols if (c,) in stats]
        ranks = {(c, f): q * (stats[(c,)][f"c{f}"] - 1) for c in found for f in folds if stats[(c,)][f"c{f}"]}
        at = folded.sparkSession.createDataFrame(
            [(c, [math.floor(ranks.get((c, f), -1)) for f in folds], [math.ceil(ranks.get((c, f), -1)) for f in folds]) for c in found],
            "feature string, lo array<long>, hi array<long>")
        sides = [F.max(F.when((F.col(f"c{f}_before") <= F.col(side)[f - 1]) & (F.col(f"c{f}_before") + F.col(f"c{f}") > F.col(side)[f - 1]), F.col("value")))
                 .alias(f"{side}{f}") for f in folds for side in ("lo", "hi")]
        rows = {r["feature"]: r for r in cum.join(F.broadcast(at), "feature").groupBy("feature").agg(*sides).collect()}
    finally:
        for h in held:
            h.unpersist()
    out = {}
    for (c, f), rank in ranks.items():
        lo, hi, frac = rows[c][f"lo{f}"], rows[c][f"hi{f}"], rank - math.floor(rank)
        out[f, c] = lo if frac == 0 or lo == hi else lo + (hi - lo) * frac
    return out


def fold_auc(folded: DataFrame, roles: Roles, cols: list[str], k: int, fold_col: str = "fold", caps: dict | None = None) -> DataFrame:
    """M01 on each fold's training part: (fit_fold, feature, auc, auc_dev). With ``caps`` {(fold, column): cap}, of the
    capped values: those from the cap on are one tie.

    One shuffle of distinct values counts positives and negatives of every
    training part (rows are not copied). Medians and rank sums both follow from
    the running counts; the NULL cells' counts join the training part's median.
    Only features x folds numbers reach the driver."""
    x = _finite_numeric(folded.select(fold_col, roles.label, *cols), cols)
    long = unpivot(x, cols, ids=[fold_col, roles.label], drop_nulls=False)
    y, folds = F.col(roles.label).cast("int"), range(1, k + 1)
    measures = {}
    for f in folds:
        measures[f"p{f}"] = F.sum(F.when(F.col(fold_col) != f, y).otherwise(0))
        measures[f"n{f}"] = F.sum(F.when(F.col(fold_col) != f, 1 - y).otherwise(0))
    held: list = []
    spark = folded.sparkSession
    try:
        cum, stats = cumulative(long.where(F.col("value").isNotNull()), ["feature"], "value", measures, keep=held)
        missing = {r["feature"]: r for r in long.where(F.col("value").isNull()).groupBy("feature").agg(
            *[e.alias(n) for n, e in measures.items()]).collect()}
        found = [c for c in cols if (c,) in stats]
        # the order statistics around each training part's median
        ranks = {(c, f): 0.5 * (stats[(c,)][f"p{f}"] + stats[(c,)][f"n{f}"] - 1) for c in found for f in folds}
        at = spark.createDataFrame([(c, [math.floor(ranks[c, f]) for f in folds], [math.ceil(ranks[c, f]) for f in folds]) for c in found],
                                   "feature string, lo array<long>, hi array<long>")
        near = []
        for f in folds:
            before, here = F.col(f"p{f}_before") + F.col(f"n{f}_before"), F.col(f"p{f}") + F.col(f"n{f}")
            for side in ("lo", "hi"):
                rank = F.col(side)[f - 1]
                near.append(F.max(F.when((before <= rank) & (before + here > rank), F.col("value"))).alias(f"{side}{f}"))
        middle = {r["feature"]: r for r in cum.join(F.broadcast(at), "feature").groupBy("feature").agg(*near).collect()}
        median = {}
        for c in found:
            for f in folds:
                lo, hi = middle[c][f"lo{f}"], middle[c][f"hi{f}"]
                if lo is not None:
                    frac = ranks[c, f] - math.floor(ranks[c, f])
                    median[c, f] = lo if frac == 0 or lo == hi else lo + (hi - lo) * frac
        caps = caps or {}
        for c, f in median:
            if caps.get((f, c)) is not None:
                median[c, f] = min(median[c, f], caps[f, c])
        medians_ = spark.createDataFrame([(c, [median.get((c, f)) for f in folds], [caps.get((f, c)) for f in folds]) for c in found],
                                         "feature string, m array<double>, cap array<double>")
        sums = []
        for f in folds:
            p, n, m, cap = F.col(f"p{f}"), F.col(f"n{f}"), F.col("m")[f - 1], F.col("cap")[f - 1]
            top, v = F.coalesce(F.col("value") >= cap, F.lit(False)), F.least(F.col("value"), cap)
            sums += [F.sum(F.when(~top, p * (F.col(f"n{f}_before") + F.lit(0.5) * n)).otherwise(0)).alias(f"u{f}"),
                     F.sum(F.when(top, p).otherwise(0)).alias(f"tp{f}"), F.sum(F.when(top, n).otherwise(0)).alias(f"tn{f}"),
                     F.sum(F.when(v < m, n).when(v == m, 0.5 * n).otherwise(0)).alias(f"b{f}"),
                     F.sum(F.when(v > m, p).when(v == m, 0.5 * p).otherwise(0)).alias(f"a{f}")]
        total = {r["feature"]: r for r in cum.join(F.broadcast(medians_), "feature").groupBy("feature").agg(*sums).collect()}
    finally:
        for h in held:
            h.unpersist()
    rows = []
    for c, f in median:
        extra = missing.get(c)
        pos, neg = (extra[f"p{f}"], extra[f"n{f}"]) if extra else (0, 0)
        t, s = total[c], stats[(c,)]
        capped = t[f"tp{f}"] * (s[f"n{f}"] - 0.5 * t[f"tn{f}"])
        u = t[f"u{f}"] + capped + pos * t[f"b{f}"] + neg * t[f"a{f}"] + 0.5 * pos * neg
        p, n = s[f"p{f}"] + pos, s[f"n{f}"] + neg
        if p and n:
            rows.append((f, c, u / p / n, abs(u / p / n - 0.5)))
    return spark.createDataFrame(rows, "fit_fold int, feature string, auc double, auc_dev double")


def near_perfect(auc: DataFrame, hi: float = LEAK_HI, lo: float = LEAK_LO) -> DataFrame:
    """Single features whose AUC is >= hi or <= lo."""
    return auc.where((F.col("auc") >= hi) | (F.col("auc") <= lo))


def label_copies(df: DataFrame, roles: Roles = Roles(), cols=None) -> DataFrame:
    """Numeric columns equal to y, or to 1 - y, on every row."""
    cols = list(cols) if cols is not None else roles.numeric_cols(df)
    y = F.col(roles.label).cast("double")
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.bool_and(F.coalesce(x.eqNullSafe(y), F.lit(False))).alias(f"s{i}"),
                 F.bool_and(F.coalesce(x.eqNullSafe(F.lit(1.0) - y), F.lit(False))).alias(f"i{i}")]
    row = df.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"s{i}").alias("same"),
                             F.col(f"i{i}").alias("inverse")) for i, c in enumerate(cols)])
    return (row.select(F.explode(arr).alias("s")).select("s.*")
            .where(F.col("same") | F.col("inverse")))


def target_correlation(df: DataFrame, roles: Roles = Roles(), cols=None) -> DataFrame:
    """Pearson r with the label after inf -> NULL -> median; constant
    or undefined -> 0. (feature, corr_abs, corr), by |r| descending."""
    cols = list(cols) if cols is not None else roles.numeric_cols(df)
    x = _finite_numeric(df.select(*cols, roles.label), cols)
    med = medians(x, cols)
    y = F.col(roles.label).cast("double")
    aggs = []
    for i, c in enumerate(cols):
        v = F.coalesce(F.col(c).cast("double"), F.lit(med[c]).cast("double"))
        aggs += [F.covar_pop(v, y).alias(f"c{i}"), F.stddev_pop(v).alias(f"sx{i}")]
    row = x.agg(F.stddev_pop(y).alias("sy"), *aggs)
    structs = []
    for i, c in enumerate(cols):
        sx, sy = F.col(f"sx{i}"), F.col("sy")
        flat = (F.coalesce(F.abs(sx), F.lit(0.0)) <= F.lit(1e-8)) | (F.coalesce(F.abs(sy), F.lit(0.0)) <= F.lit(1e-8))
        r = F.when(flat, F.lit(0.0)).otherwise(F.coalesce(F.try_divide(F.col(f"c{i}"), sx * sy), F.lit(0.0)))
        structs.append(F.struct(F.lit(c).alias("feature"), F.abs(r).alias("corr_abs"), r.alias("corr")))
    return row.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


# ---------------------------------------------------------------- M02

def mutual_information(df: DataFrame, roles: Roles = Roles(), cols=None, bins: int = MI_BINS) -> DataFrame:
    """M02 (binned): plug-in mutual information in nats between each
    discretised feature and the label, after median fill: the columns that
    ``roles.discrete`` names keep their values, the rest are cut into exact
    quantile bins (T10) of the filled values. Medians and bin edges come from one exact
    order-statistics pass (:func:`filled_order_stats`). (feature, mi)."""
    from tessera.functions.quantiles import filled_order_stats
    from tessera.operators.features import apply_qbins
    cols = list(cols) if cols is not None else roles.numeric_cols(df)
    x = _finite_numeric(df.select(*cols, roles.label), cols)
    ps = [i / bins for i in range(bins + 1)]
    fs = filled_order_stats(x, cols, {c: ps for c in cols})
    x = x.select(*[F.coalesce(F.col(c).cast("double"), F.lit(fs[c].median).cast("double")).alias(c) for c in cols],
                 roles.label)
    cont = [c for c in cols if c not in roles.discrete]
    if cont:
        x = apply_qbins(x, {c: sorted({v for v in (fs[c].quantile(p) for p in ps) if v is not None}) for c in cont})
    sel = [F.col(f"{c}_qbin").cast("double").alias(c) if c in cont else F.col(c).cast("double").alias(c)
           for c in cols]
    long = unpivot(x.select(*sel, roles.label), cols, ids=[roles.label])
    joint = long.groupBy("feature", "value", roles.label).agg(F.count(F.lit(1)).alias("nxy"))
    # windows below run over (feature x bins x classes) rows: a fixed bound
    wf = Window.partitionBy("feature")
    wx = Window.partitionBy("feature", "value")
    wy = Window.partitionBy("feature", roles.label)
    t = joint.select("feature", "nxy", F.sum("nxy").over(wf).alias("n"),
                     F.sum("nxy").over(wx).alias("nx"), F.sum("nxy").over(wy).alias("ny"))
    term = (F.col("nxy") / F.col("n")) * F.log(F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny")))
    return t.groupBy("feature").agg(F.greatest(F.sum(term), F.lit(0.0)).alias("mi"))


def digamma(m) -> Column:
    """The digamma function at an integer m >= 1, as an expression: the harmonic sum below 8, the
    asymptotic series (error under 1e-11) from there."""
    m = F.col(m) if isinstance(m, str) else m
    x, small, total = m.cast("double"), None, -EULER
    for i in range(1, 8):
        small = F.when(m == i, F.lit(total)) if small is None else small.when(m == i, F.lit(total))
        total += 1.0 / i
    inv = F.lit(1.0) / (x * x)
    series = F.log(x) - F.lit(0.5) / x - inv * (F.lit(1 / 12) - inv * (F.lit(1 / 120) - inv * (F.lit(1 / 252) - inv * F.lit(1 / 240))))
    return small.otherwise(series)


def neighbour_radius(points: DataFrame, keys: list[str], k: int, need: str = "need", rows_per_range: int = 1_000_000) -> DataFrame:
    """For distinct (keys, value) rows with a count ``n`` and their place ``at`` (0, 1, ... by value within the
    keys): the distance ``r`` from a point to its ``need``-th nearest other point (need <= k).

    Rows are cut into ranges of ``rows_per_range`` places. A range gets the k rows before and after it
    as a halo, so no window holds a whole key. Each row weighs its value's
    count, thus k rows on either side are enough."""
    step = max(rows_per_range, k + 1)
    into = F.array(F.floor(F.col("at") / step), F.floor((F.col("at") - k) / step), F.floor((F.col("at") + k) / step))
    spread = (points.withColumn("_own", F.floor(F.col("at") / step))
              .withColumn("_range", F.explode(F.array_distinct(F.filter(into, lambda x: x >= 0)))))
    w = Window.partitionBy(*keys, "_range").orderBy("value")
    near = F.array(*[F.struct((F.col("value") - F.lag("value", i).over(w)).alias("d"), F.lag("n", i).over(w).alias("c")) for i in range(1, k + 1)],
                   *[F.struct((F.lead("value", i).over(w) - F.col("value")).alias("d"), F.lead("n", i).over(w).alias("c")) for i in range(1, k + 1)])
    seen = spread.withColumn("_near", near).where(F.col("_range") == F.col("_own"))
    found = F.aggregate(
        F.array_sort(F.filter("_near", lambda x: x["d"].isNotNull())),
        F.struct((F.col("n") - 1).cast("long").alias("c"), F.lit(0.0).alias("r")),
        lambda acc, x: F.when(acc["c"] >= F.col(need), acc).otherwise(F.struct((acc["c"] + x["c"]).cast("long").alias("c"), x["d"].alias("r"))))
    return seen.withColumn("r", found["r"]).drop("_near", "_range", "_own")


def mutual_information_knn(df: DataFrame, roles: Roles = Roles(), cols=None, k: int = 3, rows_per_range: int = 1_000_000) -> DataFrame:
    """M02 (nearest neighbours, Ross 2014): mutual information in nats between each numeric feature, after median
    fill, and the label: psi(N) + <psi(k)> - <psi(n_class)> - <psi(m)>, at least 0. For a point, r is the distance to
    its k-th nearest other point of its class and m the number of all points nearer than r, itself included. (feature, mi)

    Tie rule, in place of random jitter: where r is 0, m counts the points of the same value. A class of c <= k points uses
    c - 1 neighbours; a class of one point takes no part. Distances within 1e-9 of r count as r.

    The work is on distinct values with counts. Distances come from ranges with a halo (:func:`neighbour_radius`), the
    counts within a radius from running totals of points at the radius' two ends (:func:`cumulative`)."""
    cols, label = list(cols) if cols is not None else roles.numeric_cols(df), roles.label
    x = _finite_numeric(df.select(*cols, label), cols).where(F.col(label).isNotNull())
    med = medians(x, cols)
    x = x.select(*[F.coalesce(F.col(c).cast("double"), F.lit(med[c]).cast("double")).alias(c) for c in cols], F.col(label).cast("string").alias("_y"))
    long = unpivot(x, cols, ids=["_y"])
    ranked, stats = cumulative(long, ["feature", "_y"], "value", {"n": F.count(F.lit(1)), "one": F.max(F.lit(1).cast("long"))},
                               rows_per_bucket=rows_per_range)
    sizes = {kv: s["n"] for kv, s in (stats or {}).items() if s["n"] > 1}         # features x classes numbers
    spark = df.sparkSession
    if not sizes:
        return spark.createDataFrame([], "feature string, mi double")
    classes = spark.createDataFrame([(f, y, n, min(k, n - 1)) for (f, y), n in sizes.items()], "feature string, _y string, size long, need long")
    points = ranked.join(F.broadcast(classes), ["feature", "_y"]).select("feature", "_y", "value", "n", "size", "need", F.col("one_before").alias("at"))
    # several jobs read the distances: written once
    near = materialize(neighbour_radius(points, ["feature", "_y"], k, rows_per_range=rows_per_range), "neighbours")
    reach = F.col("r") * F.lit(1 - 1e-9)
    near = near.withColumn("low", F.col("value") - reach).withColumn("high", F.col("value") + reach)
    zero = F.lit(0).cast("long").alias("w")
    ends = (near.select("feature", "value", F.col("n").alias("w"))
            .unionByName(near.select("feature", F.col("low").alias("value"), zero)).unionByName(near.select("feature", F.col("high").alias("value"), zero)))
    totals, _ = cumulative(ends, ["feature"], "value", {"w": F.sum("w")}, rows_per_bucket=rows_per_range)
    totals = materialize(totals, "totals")
    below = totals.select("feature", F.col("value").alias("low"), F.col("w_before").alias("below"))
    upto = totals.select("feature", F.col("value").alias("high"), (F.col("w_before") + F.col("w")).alias("upto"))
    m = near.join(below, ["feature", "low"]).join(upto, ["feature", "high"]).withColumn("m", F.col("upto") - F.col("below"))
    n, size = F.col("n").cast("double"), F.sum("n")
    mean = lambda e: F.sum(n * e) / size
    mi = digamma(size) + mean(digamma("need")) - mean(digamma("size")) - mean(digamma("m"))
    return m.groupBy("feature").agg(F.greatest(mi, F.lit(0.0)).alias("mi"))


def plot_order(columns: list[str], spark, shap: DataFrame | None = None, auc: DataFrame | None = None) -> DataFrame:
    """Features ranked by the SHAP report if given, else the AUC report;
    remaining columns after, in table order. (position, column_name)."""
    rep, score = (shap, "shap_mean_abs") if shap is not None else (auc, "auc")
    allc = spark.createDataFrame([(i, c) for i, c in enumerate(columns)], "tpos int, column_name string")
    if rep is None:
        return allc.select((F.col("tpos") + 1).alias("position"), "column_name")
    ranked = rep.select(F.col("feature").alias("column_name"), score)
    j = allc.join(ranked, "column_name", "left")
    w = Window.orderBy(F.col(score).desc_nulls_last(), F.when(F.col(score).isNull(), F.col("tpos")), "column_name")
    # window over the column list only (schema width, not data)
    return j.select(F.row_number().over(w).cast("long").alias("position"), "column_name")

