"""Registered profiling/scoring/selection/evaluation queries with oracles:
A06-A15, P11, M01-M03, M07-M09, F01-F03, F05-F07, E01-E05, E13."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.exprs import r6
from tessera.operators import evaluate as EV
from tessera.operators import profile as P
from tessera.operators import score as M
from tessera.operators import select as SEL
from tessera.operators import split as S
from tessera.plans import sqlgen as G
from tessera.plans.registry import register
from tessera.roles import Roles
from tessera.sources.bank import bank_train, sql_with

NUM = ["age", "balance", "duration", "campaign", "previous"]
CAT = ["job", "marital", "education", "contact"]
DISCRETE = ("campaign",)     # the numeric column whose values are classes for M02
ROLES = Roles(discrete=DISCRETE)
K = 5


def _round_all(df, skip=()):
    types = dict(df.dtypes)
    return df.select(*[r6(c).alias(c) if types[c] in ("double", "float") and c not in skip else F.col(c)
                       for c in df.columns])


# ------------------------------------------------------------------ derived inputs

def _train_p(spark, d):
    """Training rows with a deterministic score p derived from the data."""
    return bank_train(spark, d).withColumn(
        "p", F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("previous") - 380000.0) / 50000.0)))


_P_SQL = ", tp AS (SELECT *, 1.0 / (1.0 + exp(-(previous - 380000.0) / 50000.0)) AS p FROM train)"


def _train_extra(spark, d):
    """Training rows plus derived columns: a label leaker, copies of the
    label, a rescaled duplicate of previous and a nearly flat column."""
    return bank_train(spark, d).select(
        "id", *NUM, "y",
        (F.col("y") * 1000 + F.col("age")).alias("leak"),
        F.col("y").alias("y_copy"), (F.lit(1) - F.col("y")).alias("y_flip"),
        (F.col("previous") / 1000.0).alias("price_k"),
        ((F.col("age") % 2) * 0.001).alias("flat"))


_EXTRA_SQL = (", tx AS (SELECT id, " + ", ".join(NUM) + ", y, y * 1000 + age AS leak, y AS y_copy, 1 - y AS y_flip, "
              "previous / 1000.0 AS price_k, (age % 2) * 0.001 AS flat FROM train)")
XNUM = NUM + ["leak", "price_k", "flat"]


# ------------------------------------------------------------------ A06-A15

def _describe_sql():
    num = ["id"] + NUM + ["y"]
    parts = []
    for c in num:
        x = G.dbl(c)
        parts.append(
            f"SELECT '{c}' AS column_name, count({c}) AS count, CAST(NULL AS BIGINT) AS \"unique\", "
            f"CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, round(avg({x}), 6) AS mean, "
            f"round(stddev_samp({x}), 6) AS std, round(min({x}), 6) AS min, round(quantile_cont({x}, 0.25), 6) AS q25, "
            f"round(quantile_cont({x}, 0.5), 6) AS q50, round(quantile_cont({x}, 0.75), 6) AS q75, "
            f"round(max({x}), 6) AS max FROM dtrain")
    for c in CAT:
        parts.append(
            f"SELECT '{c}' AS column_name, (SELECT count({c}) FROM dtrain) AS count, "
            f"(SELECT count(DISTINCT {c}) FROM dtrain) AS \"unique\", t.v AS top, t.n AS freq, "
            "NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS q25, "
            "NULL::DOUBLE AS q50, NULL::DOUBLE AS q75, NULL::DOUBLE AS max "
            f"FROM (SELECT {c} AS v, count(*) AS n FROM dtrain WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY n DESC, v LIMIT 1) t")
    return sql_with(" UNION ALL ".join(parts))


@register("a06_describe", _describe_sql())
def a06_describe(spark, d):
    return _round_all(P.describe(bank_train(spark, d, dirty=True), ROLES))


@register("a07_missingness", sql_with(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, "
    f"round((count(*) - count({c})) / count(*), 6) AS missing_pct FROM dtrain"
    for c in ["id", "age", *CAT[:3], "contact", "balance", "duration", "campaign", "previous", "y"])))
def a07_missingness(spark, d):
    return _round_all(P.missingness(bank_train(spark, d, dirty=True)))


@register("a08_correlation_matrix", sql_with("SELECT feature_a, feature_b, pos_a, pos_b, round(corr, 6) AS corr FROM ("
                                             + G.corr_pairs("train", NUM, False, True) + ")"))
def a08_correlation_matrix(spark, d):
    return _round_all(P.correlation_pairs(bank_train(spark, d), NUM))


@register("a09_top_values", sql_with(
    ", l AS (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS value FROM dtrain WHERE {c} IS NOT NULL"
                                    for c in CAT) + ")\n"
    "SELECT column_name, rank, value, count FROM (SELECT column_name, value, count(*) AS count, "
    "row_number() OVER (PARTITION BY column_name ORDER BY count(*) DESC, value) AS rank "
    f"FROM l GROUP BY column_name, value) WHERE rank <= {P.TOP_VALUES}"))
def a09_top_values(spark, d):
    return P.top_values(bank_train(spark, d, dirty=True), CAT)


@register("a10_skewness", sql_with(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(skewness({G.dbl(c)}), 6) AS skewness FROM train" for c in NUM)))
def a10_skewness(spark, d):
    return _round_all(P.skewness(bank_train(spark, d), NUM))


@register("a11_top_correlated_pairs", sql_with(
    _EXTRA_SQL + "\nSELECT feature_a, feature_b, round(corr, 6) AS corr, round(abs(corr), 6) AS corr_abs FROM ("
    + G.corr_pairs("tx", XNUM, True, False) + ") WHERE corr IS NOT NULL "
    f"ORDER BY abs(corr) DESC, feature_a, feature_b LIMIT {P.TOP_PAIRS}"))
def a11_top_correlated_pairs(spark, d):
    return _round_all(P.top_correlated_pairs(_train_extra(spark, d), XNUM))


@register("p11_high_correlation", sql_with(
    _EXTRA_SQL + "\nSELECT feature_a, feature_b, round(corr, 6) AS corr FROM (" + G.corr_pairs("tx", XNUM, True, False)
    + ") WHERE abs(corr) > 0.9"))
def p11_high_correlation(spark, d):
    return _round_all(P.high_correlation(_train_extra(spark, d), XNUM))


def _hist_sql():
    parts = []
    for c in NUM:
        x = G.dbl(c)
        parts.append(
            f"SELECT '{c}' AS column_name, bin, round(lo + bin * w, 6) AS bin_lo, round(lo + (bin + 1) * w, 6) AS bin_hi, "
            f"count(*) AS count FROM (SELECT lo, w, CAST(least(floor(({x} - lo) / w), {P.HIST_BINS - 1}) AS INTEGER) AS bin "
            f"FROM train, (SELECT CASE WHEN min({x}) = max({x}) THEN min({x}) - 0.5 ELSE min({x}) END AS lo, "
            f"(CASE WHEN min({x}) = max({x}) THEN max({x}) + 0.5 ELSE max({x}) END - "
            f"CASE WHEN min({x}) = max({x}) THEN min({x}) - 0.5 ELSE min({x}) END) / {P.HIST_BINS} AS w FROM train) "
            f"WHERE {c} IS NOT NULL) GROUP BY bin, lo, w")
    return sql_with(" UNION ALL ".join(parts))


@register("a12_histogram", _hist_sql())
def a12_histogram(spark, d):
    return _round_all(P.histogram(bank_train(spark, d), NUM))


KDE_COLS = NUM


def _kde_sql():
    parts = []
    for c in KDE_COLS:
        x = G.dbl(c)
        parts.append(
            f"SELECT y, '{c}' AS column_name, j AS point, a + j * st AS x, "
            f"sum(exp(-0.5 * pow((a + j * st - v) / bw, 2))) / (n * bw * sqrt(2 * pi())) AS density FROM ("
            f"SELECT t.y, {x} AS v, s.n, s.bw, s.a, s.st FROM train t JOIN ("
            f"SELECT y, n, bw, lo - 3 * bw AS a, (hi + 3 * bw - (lo - 3 * bw)) / {P.KDE_POINTS - 1} AS st FROM ("
            f"SELECT y, count({x}) AS n, stddev_samp({x}) * pow(count({x}), -0.2) AS bw, min({x}) AS lo, max({x}) AS hi "
            f"FROM train GROUP BY y)) s ON s.y = t.y WHERE {c} IS NOT NULL), range({P.KDE_POINTS}) g(j) "
            f"GROUP BY y, j, a, st, n, bw")
    body = " UNION ALL ".join(parts)
    return sql_with(f"SELECT y, column_name, point, round(x, 6) AS x, round(density * 1e6, 6) AS density_e6 FROM ({body})")


@register("a13_density_by_class", _kde_sql())
def a13_density_by_class(spark, d):
    k = P.density(bank_train(spark, d), KDE_COLS, by="y")
    return k.select("y", "column_name", "point", r6("x").alias("x"), r6(F.col("density") * 1e6).alias("density_e6"))


def _kde_binned_sql():
    parts = []
    for c in KDE_COLS:
        x = G.dbl(c)
        stats = (f"(SELECT y, n, bw, lo, lo - 3 * bw AS a, (hi + 3 * bw - (lo - 3 * bw)) / {P.KDE_POINTS - 1} AS st FROM ("
                 f"SELECT y, count({x}) AS n, stddev_samp({x}) * pow(count({x}), -0.2) AS bw, min({x}) AS lo, max({x}) AS hi "
                 f"FROM train GROUP BY y))")
        cells = (f"(SELECT y, floor(p) AS i, count(*) AS k, sum(p - floor(p)) AS up FROM (SELECT t.y, "
                 f"({x} - s.lo) / s.bw * {P.KDE_CELLS} AS p FROM train t JOIN {stats} s ON s.y = t.y WHERE {c} IS NOT NULL) GROUP BY 1, 2)")
        border = [f"exp(-0.5 * pow((a + j * st - lo - (i + {e}) * bw / {P.KDE_CELLS}) / bw, 2))" for e in (0, 1)]
        parts.append(f"SELECT y, '{c}' AS column_name, j AS point, a + j * st AS x, "
                     f"sum((k - up) * {border[0]} + up * {border[1]}) / (n * bw * sqrt(2 * pi())) AS density "
                     f"FROM {cells} JOIN {stats} USING (y), range({P.KDE_POINTS}) g(j) GROUP BY y, j, a, st, n, bw")
    return sql_with("SELECT y, column_name, point, round(x, 6) AS x, round(density * 1e6, 3) AS density_e6 FROM ("
                    + " UNION ALL ".join(parts) + ")")


@register("a13_density_binned", _kde_binned_sql())
def a13_density_binned(spark, d):
    """The curves of a13_density_by_class by linear binning."""
    k = P.density_binned(bank_train(spark, d), KDE_COLS, by="y")
    return k.select("y", "column_name", "point", r6("x").alias("x"), F.round(F.col("density") * 1e6, 3).alias("density_e6"))


@register("a14_shape", sql_with("SELECT count(*) AS n_rows, 11 AS n_cols FROM train"))
def a14_shape(spark, d):
    return P.shape(bank_train(spark, d))


@register("a15_class_weight", sql_with(
    "SELECT round(CASE WHEN count(*) FILTER (WHERE y = 1) > 0 THEN count(*) FILTER (WHERE y = 0) * 1.0 / "
    "count(*) FILTER (WHERE y = 1) ELSE 1.0 END, 6) AS class_weight FROM train"))
def a15_class_weight(spark, d):
    return _round_all(P.class_weight(bank_train(spark, d)))


# ------------------------------------------------------------------ M01-M03, M07-M09

_M01_SQL = (", l AS (" + G.median_filled_long("train", NUM, ["y"]) + ")\n"
            "SELECT feature, round(auc, 6) AS auc, round(abs(auc - 0.5), 6) AS auc_dev FROM " + G.auc("l", ["feature"]))


@register("m01_univariate_auc", sql_with(_M01_SQL))
def m01_univariate_auc(spark, d):
    return _round_all(M.univariate_auc(bank_train(spark, d), ROLES))


def _mi_sql(src_cols=NUM):
    ps = ", ".join(str(i / M.MI_BINS) for i in range(M.MI_BINS + 1))
    return (", l AS (" + G.median_filled_long("train", src_cols, ["y"]) + "),\n"
            f"st AS (SELECT feature, count(DISTINCT value) AS nd, "
            f"list_sort(list_distinct(quantile_cont(value, [{ps}]))) AS e FROM l GROUP BY feature),\n"
            "b AS (SELECT l.feature, l.y, CASE WHEN l.feature IN (" + ", ".join(f"'{c}'" for c in DISCRETE) + ") THEN l.value "
            "WHEN len(st.e) < 2 THEN NULL ELSE greatest(len(list_filter(st.e, lambda x: x < l.value)) - 1, 0) END AS v "
            "FROM l JOIN st ON st.feature = l.feature),\n"
            "j AS (SELECT feature, v, y, count(*) AS nxy FROM b WHERE v IS NOT NULL GROUP BY feature, v, y),\n"
            "t AS (SELECT feature, nxy, sum(nxy) OVER (PARTITION BY feature) AS n, sum(nxy) OVER (PARTITION BY feature, v) AS nx, "
            "sum(nxy) OVER (PARTITION BY feature, y) AS ny FROM j),\n"
            "mi AS (SELECT feature, greatest(sum(nxy / n * ln(nxy * n / (nx * ny))), 0.0) AS mi FROM t GROUP BY feature)\n")


@register("m02_mutual_information", sql_with(_mi_sql() + "SELECT feature, round(mi, 6) AS mi FROM mi"))
def m02_mutual_information(spark, d):
    return _round_all(M.mutual_information(bank_train(spark, d), ROLES))


def _mi_knn_sql(k=3):
    """Row by row: the k-th neighbour within the class from lags and leads, counts by a range frame over all rows."""
    left = {0: "0.0", **{i: f"coalesce(value - lag(value, {i}) OVER c, 'inf'::DOUBLE)" for i in range(1, k + 1)}}
    right = {0: "0.0", **{i: f"coalesce(lead(value, {i}) OVER c - value, 'inf'::DOUBLE)" for i in range(1, k + 1)}}
    ways = ", ".join(f"greatest({left[k - a]}, {right[a]})" for a in range(k + 1))
    psi = lambda e: (f"(CASE WHEN {e} < 8 THEN -{M.EULER} + coalesce(list_sum(list_transform(range(1, {e}::BIGINT), lambda i: 1.0 / i)), 0) "  # noqa: E731
                     f"ELSE ln({e}) - 1 / (2.0 * {e}) - 1 / (12.0 * {e} ** 2) + 1 / (120.0 * {e} ** 4) - 1 / (252.0 * {e} ** 6) END)")
    return (", l AS (" + G.median_filled_long("train", NUM, ["y"]) + "),\n"
            f"r AS (SELECT feature, y, value, least({ways}) * (1 - 1e-9) AS r, count(*) OVER (PARTITION BY feature, y) AS nc "
            "FROM l WINDOW c AS (PARTITION BY feature, y ORDER BY value)),\n"
            "m AS (SELECT feature, nc, count(*) OVER (PARTITION BY feature ORDER BY value RANGE BETWEEN r PRECEDING AND r FOLLOWING) AS m FROM r)\n"
            f"SELECT feature, round(greatest({psi('count(*)')} + {psi(k)} - avg({psi('nc')}) - avg({psi('m')}), 0.0), 6) AS mi FROM m GROUP BY feature")


@register("m02_mi_knn", sql_with(_mi_knn_sql()))
def m02_mi_knn(spark, d):
    return _round_all(M.mutual_information_knn(bank_train(spark, d), ROLES))


@register("m03_target_correlation", sql_with(
    ", l AS (" + G.median_filled_long("train", NUM, ["y"]) + "),\n"
    "r AS (SELECT feature, CASE WHEN coalesce(stddev_pop(value), 0) <= 1e-8 OR coalesce(stddev_pop(y), 0) <= 1e-8 THEN 0.0 "
    "ELSE coalesce(covar_pop(value, y) / (stddev_pop(value) * stddev_pop(y)), 0.0) END AS corr FROM l GROUP BY feature)\n"
    "SELECT feature, round(abs(corr), 6) AS corr_abs, round(corr, 6) AS corr FROM r"))
def m03_target_correlation(spark, d):
    return _round_all(M.target_correlation(bank_train(spark, d), ROLES))


@register("m07_near_perfect", sql_with(
    _EXTRA_SQL + ", l AS (" + G.median_filled_long("tx", XNUM, ["y"]) + ")\n"
    "SELECT feature, round(auc, 6) AS auc, round(abs(auc - 0.5), 6) AS auc_dev FROM " + G.auc("l", ["feature"])
    + " WHERE auc >= 0.999 OR auc <= 0.001"))
def m07_near_perfect(spark, d):
    return _round_all(M.near_perfect(M.univariate_auc(_train_extra(spark, d), ROLES, XNUM)))


@register("m08_label_copies", sql_with(
    _EXTRA_SQL + "\nSELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, bool_and(coalesce({G.dbl(c)} = CAST(y AS DOUBLE), false)) AS same, "
        f"bool_and(coalesce({G.dbl(c)} = 1.0 - y, false)) AS inverse FROM tx"
        for c in XNUM + ["y_copy", "y_flip"]) + ") WHERE same OR inverse"))
def m08_label_copies(spark, d):
    return M.label_copies(_train_extra(spark, d), ROLES, XNUM + ["y_copy", "y_flip"])


@register("m09_plot_order", sql_with(
    ", l AS (" + G.median_filled_long("train", NUM, ["y"]) + "), a AS (SELECT * FROM " + G.auc("l", ["feature"]) + "),\n"
    "c AS (" + " UNION ALL ".join(f"SELECT {i} AS tpos, '{c}' AS column_name" for i, c in enumerate(NUM)) + ")\n"
    "SELECT row_number() OVER (ORDER BY a.auc DESC NULLS LAST, CASE WHEN a.auc IS NULL THEN c.tpos END, c.column_name) "
    "AS position, c.column_name FROM c LEFT JOIN a ON a.feature = c.column_name"))
def m09_plot_order(spark, d):
    auc = M.univariate_auc(bank_train(spark, d), ROLES)
    return M.plot_order(NUM, spark, auc=auc)


# ------------------------------------------------------------------ F01-F03, F05-F07

@register("f01_prune_correlated", sql_with(
    _EXTRA_SQL + ", pr AS (" + G.corr_pairs("tx", XNUM, True, False) + "),\n"
    "c AS (" + " UNION ALL ".join(f"SELECT {i} AS pos, '{c}' AS column_name" for i, c in enumerate(XNUM)) + ")\n"
    "SELECT row_number() OVER (ORDER BY pos) AS pos, column_name FROM c WHERE column_name NOT IN "
    f"(SELECT feature_a FROM pr WHERE abs(corr) >= {SEL.CORR_T} AND corr IS NOT NULL)"))
def f01_prune_correlated(spark, d):
    return SEL.kept_frame(spark, SEL.prune_correlated(_train_extra(spark, d), XNUM, SEL.CORR_T))


@register("f02_prune_low_variance", sql_with(
    _EXTRA_SQL + ", v AS (" + " UNION ALL ".join(
        f"SELECT {i} AS pos, '{c}' AS column_name, var_samp({G.dbl(c)}) AS v FROM tx" for i, c in enumerate(XNUM)) + ")\n"
    f"SELECT row_number() OVER (ORDER BY pos) AS pos, column_name FROM v WHERE v > {SEL.VAR_T}"))
def f02_prune_low_variance(spark, d):
    return SEL.kept_frame(spark, SEL.prune_low_variance(_train_extra(spark, d), XNUM, SEL.VAR_T))


@register("f03_select_by_mi", sql_with(
    _mi_sql() + f"SELECT row_number() OVER (ORDER BY mi DESC, feature) AS pos, feature AS column_name FROM mi "
    f"ORDER BY mi DESC, feature LIMIT {SEL.MI_K}"))
def f03_select_by_mi(spark, d):
    return SEL.kept_frame(spark, SEL.select_by_mi(bank_train(spark, d), ROLES, NUM, SEL.MI_K))


@register("f05_export_top", sql_with(
    _M01_SQL.replace("SELECT feature, round(auc, 6) AS auc, round(abs(auc - 0.5), 6) AS auc_dev FROM",
                     "SELECT feature, round(auc, 6) AS auc FROM") + f" ORDER BY auc DESC, feature LIMIT {SEL.TOP_K}"))
def f05_export_top(spark, d):
    rep = M.univariate_auc(bank_train(spark, d), ROLES).select("feature", "auc")
    return _round_all(EV.top_k(rep, "auc", SEL.TOP_K))


@register("f06_top_of_reports", sql_with(
    _mi_sql() + ", l2 AS (" + G.median_filled_long("train", NUM, ["y"]) + "),\n"
    "au AS (SELECT * FROM " + G.auc("l2", ["feature"]) + "),\n"
    "rep AS (SELECT 'auc' AS report, feature, auc AS score FROM au UNION ALL SELECT 'mi', feature, mi FROM mi)\n"
    "SELECT report, feature, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER "
    f"(PARTITION BY report ORDER BY score DESC, feature) AS rank FROM rep) WHERE rank <= {SEL.TOP_N}"))
def f06_top_of_reports(spark, d):
    tr = bank_train(spark, d)
    reps = {"auc": M.univariate_auc(tr, ROLES).select("feature", F.col("auc").alias("score")),
            "mi": M.mutual_information(tr, ROLES).select("feature", F.col("mi").alias("score"))}
    return _round_all(SEL.top_of_reports(reps, SEL.TOP_N))


@register("f07_leakers_in_fold", sql_with(
    _EXTRA_SQL + ", f AS (" + G.folds("tx", K) + "),\n"
    "c AS (SELECT ff.fold AS fit_fold, f.* EXCLUDE (fold) FROM f JOIN (SELECT DISTINCT fold FROM f) ff ON f.fold <> ff.fold),\n"
    "l AS (" + G.median_filled_long("c", XNUM, ["fit_fold", "y"], group="fit_fold") + ")\n"
    "SELECT fit_fold AS fold, feature, round(auc, 6) AS auc FROM " + G.auc("l", ["fit_fold", "feature"])
    + " WHERE auc >= 0.999 OR auc <= 0.001"))
def f07_leakers_in_fold(spark, d):
    f = S.stratified_kfold(_train_extra(spark, d), K)
    flags = SEL.leakers_by_fold(f, ROLES, XNUM, K)
    return _round_all(flags)


# ------------------------------------------------------------------ E01-E05, E13

@register("e01_roc_auc", sql_with(_P_SQL + ", l AS (SELECT 1 AS k, p AS value, y FROM tp)\n"
                                  "SELECT round(auc, 6) AS auc FROM " + G.auc("l", ["k"])))
def e01_roc_auc(spark, d):
    return _round_all(M.roc_auc(_train_p(spark, d), "y", "p"))


@register("e02_accuracy", sql_with(_P_SQL + "\nSELECT round(avg(CASE WHEN (p >= 0.5)::INT = y THEN 1.0 ELSE 0.0 END), 6) "
                                   "AS accuracy FROM tp"))
def e02_accuracy(spark, d):
    t = _train_p(spark, d).withColumn("pred", (F.col("p") >= 0.5).cast("int"))
    return _round_all(EV.accuracy(t))


@register("e04_precision_recall_f1", sql_with(_P_SQL + """
, c AS (SELECT count(*) FILTER (WHERE y = 1 AND p >= 0.5) AS tp, count(*) FILTER (WHERE y = 0 AND p >= 0.5) AS fp,
               count(*) FILTER (WHERE y = 1 AND p < 0.5) AS fn, count(*) FILTER (WHERE y = 0 AND p < 0.5) AS tn FROM tp)
SELECT tp, fp, fn, tn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
       round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))), 6) AS f1 FROM c"""))
def e04_precision_recall_f1(spark, d):
    t = _train_p(spark, d).withColumn("pred", (F.col("p") >= 0.5).cast("int"))
    return _round_all(EV.confusion_metrics(t))


_FOLD_AUC_SQL = (_P_SQL + ", f AS (" + G.folds("tp", K) + "),\n"
                 "fm AS (SELECT fold, auc AS roc_auc FROM " + G.auc("(SELECT fold, p AS value, y FROM f)", ["fold"]) + ")\n")


@register("e05_fold_metrics", sql_with(
    _FOLD_AUC_SQL + "SELECT fold, round(roc_auc, 6) AS roc_auc FROM fm UNION ALL "
    "SELECT 0 AS fold, round(auc, 6) AS roc_auc FROM " + G.auc("(SELECT 1 AS k, p AS value, y FROM f)", ["k"])))
def e05_fold_metrics(spark, d):
    f = S.stratified_kfold(_train_p(spark, d), K)
    return _round_all(EV.fold_metrics(f, "y", "p"))


@register("e03_cv_mean_std", sql_with(
    _FOLD_AUC_SQL + "SELECT round(avg(roc_auc), 6) AS mean, round(stddev_pop(roc_auc), 6) AS std FROM fm"))
def e03_cv_mean_std(spark, d):
    f = S.stratified_kfold(_train_p(spark, d), K)
    per = EV.fold_metrics(f, "y", "p").where(F.col("fold") > 0)
    return _round_all(EV.mean_std(per, "roc_auc"))


@register("e13_best_setting", sql_with(
    _FOLD_AUC_SQL + "SELECT fold, round(roc_auc, 6) AS roc_auc FROM fm ORDER BY roc_auc DESC, fold LIMIT 1"))
def e13_best_setting(spark, d):
    f = S.stratified_kfold(_train_p(spark, d), K)
    per = EV.fold_metrics(f, "y", "p").where(F.col("fold") > 0)
    return _round_all(EV.best_setting(per, "roc_auc", "fold"))
