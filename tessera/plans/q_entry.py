"""Registered queries of the schema operators (P01, P02, P04, P05, P06, P09,
A03, S05, T03), of the missing-value rule on entry, and of the in-fold steps
(T05c, F08, S12), each over whole tables of the bank view."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import roles as R
from tessera.functions.exprs import r6, unpivot
from tessera.operators import clean as C
from tessera.operators import combine as J
from tessera.operators import infold as IN
from tessera.operators import profile as P
from tessera.operators import score as M
from tessera.operators import select as SEL
from tessera.operators import split as S
from tessera.plans import q_clean, q_profile, q_score, sqlgen as G
from tessera.plans.q_project import NAN_MOD, NEG_INF_MOD, POS_INF_MOD
from tessera.plans.q_score import DISCRETE, _round_all
from tessera.plans.registry import ORACLES, register
from tessera.sources.bank import bank_test, bank_train, bank_view, sql_with

NUM = ["age", "balance", "duration", "campaign", "previous"]
ROLES = R.Roles(discrete=DISCRETE)
COLUMNS = ["id", "age", "job", "marital", "education", "contact", "balance", "duration", "campaign", "previous", "y"]
TEXT = ("job", "marital", "education", "contact")


# ------------------------------------------------------------------ schema operators

def _values(df):
    """(column_name, n_values) of every column."""
    return (unpivot(df, df.columns, cast="string").groupBy("feature").agg(F.count(F.lit(1)).alias("n_values"))
            .withColumnRenamed("feature", "column_name"))


def _role(c):
    return "key" if c == "id" else "label" if c == "y" else "categorical" if c in TEXT else "numeric"


def _counts_sql(src, rows):
    return " UNION ALL ".join(f"SELECT {extra}'{c}' AS column_name, count({c}) AS n_values FROM {src}" for c, extra in rows)


@register("p01_roles", sql_with(_counts_sql("dtrain", [(c, f"'{_role(c)}' AS role, ") for c in COLUMNS])))
def p01_roles(spark, d):
    df = bank_train(spark, d, dirty=True)
    roles = spark.createDataFrame(R.role_table(df, ROLES), "column_name string, role string")
    return _values(df).join(roles, "column_name").select("role", "column_name", "n_values")


@register("p02_drop_key", sql_with("SELECT * EXCLUDE (id) FROM train"))
def p02_drop_key(spark, d):
    return R.drop_key(bank_train(spark, d), ROLES)


@register("p04_schema_diff", sql_with(_counts_sql("(SELECT * FROM train)", [("y", "'train' AS side, ")])
                                      + " UNION ALL " + _counts_sql("(SELECT age AS extra FROM test)", [("extra", "'test' AS side, ")])))
def p04_schema_diff(spark, d):
    a, b = bank_train(spark, d), bank_test(spark, d).withColumn("extra", F.col("age"))
    only_a, only_b = J.schema_diff(a, b)
    return (_values(a.select(*only_a)).withColumn("side", F.lit("train"))
            .unionByName(_values(b.select(*only_b)).withColumn("side", F.lit("test"))))


@register("p05_feature_list", sql_with("SELECT id, y, job, balance FROM train"))
def p05_feature_list(spark, d):
    return R.project_list(bank_train(spark, d), ["balance", "job", "not_there"], always=("id", "y"))


@register("p06_reorder_kept", sql_with("SELECT id, y, previous, age, job, contact FROM train"))
def p06_reorder_kept(spark, d):
    return R.reorder_kept(bank_train(spark, d), ["previous", "age"], ["job", "contact", "age"], always=("id", "y"))


@register("p09_suspicious_names", sql_with("SELECT id, age, previous FROM train"))
def p09_suspicious_names(spark, d):
    df = bank_train(spark, d).select("id", "age", "previous", "y", F.col("y").alias(" Target "), F.col("age").alias("SPLIT"))
    return df.drop(*R.suspicious_columns(df))


_TYPE_SQL = ("CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
             "WHEN 'VARCHAR' THEN 'string' ELSE column_type END")


@register("a03_column_types", sql_with(
    ", ty AS (SELECT column_name, " + _TYPE_SQL + " AS dtype FROM (DESCRIBE SELECT * FROM dtrain))\n"
    "SELECT position, column_name, dtype, role, n_values FROM (" + _counts_sql(
        "dtrain", [(c, f"{i + 1} AS position, '{_role(c)}' AS role, ") for i, c in enumerate(COLUMNS)]) + ") JOIN ty USING (column_name)"))
def a03_column_types(spark, d):
    df = bank_train(spark, d, dirty=True)
    return P.column_types(df, ROLES).join(_values(df), "column_name").select("position", "column_name", "dtype", "role", "n_values")


@register("a02_duplicate_whole_rows", sql_with(
    "SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS c FROM "
    "(SELECT * FROM dtrain UNION ALL SELECT * FROM dtrain WHERE id % 7 = 0) GROUP BY " + ", ".join(COLUMNS) + ")"))
def a02_duplicate_whole_rows(spark, d):
    """Whole rows, with every seventh key's row once more."""
    tr = bank_train(spark, d, dirty=True)
    return P.duplicate_rows(tr.unionByName(tr.where(F.col("id") % 7 == 0)))


@register("s05_required_columns", sql_with("SELECT id, y FROM train"))
def s05_required_columns(spark, d):
    df = bank_train(spark, d)
    R.require_columns(df, ["id", "y"], "train")
    return df.select("id", "y")


@register("t03_inline_fill", ORACLES["t01_impute_median"])
def t03_inline_fill(spark, d):
    return q_clean._round(C.fill_median_inline(bank_train(spark, d).select("id", *NUM), NUM), NUM)


@register("a14_preview", sql_with(f"SELECT id, age, job, y FROM train ORDER BY id LIMIT {P.PREVIEW_ROWS}"))
def a14_preview(spark, d):
    return P.preview(bank_train(spark, d)).select("id", "age", "job", "y")


# ------------------------------------------------------------------ missing values on entry

def nonfinite_train(spark, d):
    """Training rows with text nulls whose balance is NaN, inf or -inf on some keys."""
    key = F.col("id")
    raw = (F.when(key % NAN_MOD == 0, F.lit(float("nan"))).when(key % POS_INF_MOD == 0, F.lit(float("inf")))
           .when(key % NEG_INF_MOD == 0, F.lit(float("-inf"))).otherwise(F.col("balance").cast("double")))
    return bank_train(spark, d, dirty=True).withColumn("balance", raw)


def _on_nonfinite(name: str) -> str:
    """The SQL of a query over the same rows with those balances NULL."""
    head = sql_with("")
    assert ORACLES[name].startswith(head)
    body = ORACLES[name][len(head):]
    for source in ("dtrain", "train"):
        body = body.replace(f"FROM {source}", "FROM ntrain")
    return (head.rstrip() + f",\nntrain AS (SELECT * REPLACE (CASE WHEN id % {NAN_MOD} = 0 OR id % {POS_INF_MOD} = 0 OR id % {NEG_INF_MOD} = 0 "
            "THEN NULL ELSE CAST(balance AS DOUBLE) END AS balance) FROM dtrain)\n" + body)


@register("a01_missing_nonfinite", _on_nonfinite("a01_missing_counts"))
def a01_missing_nonfinite(spark, d):
    return P.missing_counts(nonfinite_train(spark, d))


@register("a05_outliers_nonfinite", _on_nonfinite("a05_iqr_outliers"))
def a05_outliers_nonfinite(spark, d):
    return P.iqr_outlier_counts(nonfinite_train(spark, d), ROLES)


@register("a06_describe_nonfinite", _on_nonfinite("a06_describe"))
def a06_describe_nonfinite(spark, d):
    return _round_all(P.describe(nonfinite_train(spark, d), ROLES))


@register("a08_correlation_nonfinite", _on_nonfinite("a08_correlation_matrix"))
def a08_correlation_nonfinite(spark, d):
    return _round_all(P.correlation_pairs(nonfinite_train(spark, d), NUM))


@register("a12_histogram_nonfinite", _on_nonfinite("a12_histogram"))
def a12_histogram_nonfinite(spark, d):
    return _round_all(P.histogram(nonfinite_train(spark, d), NUM))


@register("a16_validation_nonfinite", _on_nonfinite("a16_validation"))
def a16_validation_nonfinite(spark, d):
    return P.validation_table(nonfinite_train(spark, d), ROLES)


@register("t01_impute_nonfinite", _on_nonfinite("t01_impute_median"))
def t01_impute_nonfinite(spark, d):
    tr = nonfinite_train(spark, d).select("id", *NUM)
    return q_clean._round(C.apply_median(tr, C.fit_median(tr, NUM)), NUM)


@register("t08_standardize_nonfinite", _on_nonfinite("t08_standardize"))
def t08_standardize_nonfinite(spark, d):
    tr = nonfinite_train(spark, d).select("id", *NUM)
    return q_clean._round(C.apply_standard(tr, C.fit_standard(tr, NUM)), NUM)


@register("t14_clean_chain_nonfinite", _on_nonfinite("t14_clean_chain"))
def t14_clean_chain_nonfinite(spark, d):
    tr, te = nonfinite_train(spark, d), bank_test(spark, d, dirty=True)
    st = C.fit_clean(tr, ROLES, cap_pct=q_clean.CAP_Q, log1p_balance=True)
    a = C.apply_clean(tr, st, ROLES).withColumn("split", F.lit("train"))
    b = C.apply_clean(te, st, ROLES).withColumn("split", F.lit("test")).withColumn("y", F.lit(None).cast("int"))
    return q_clean._round(a.unionByName(b).select("id", "y", "split", *NUM, *q_clean.CAT), NUM + q_clean.CAT)


@register("f01_prune_nonfinite", _on_nonfinite("f01_prune_correlated"))
def f01_prune_nonfinite(spark, d):
    tr = nonfinite_train(spark, d).select(
        "id", *NUM, "y", (F.col("y") * 1000 + F.col("age")).alias("leak"),
        (F.col("previous") / 1000.0).alias("price_k"), ((F.col("age") % 2) * 0.001).alias("flat"))
    return SEL.kept_frame(spark, SEL.prune_correlated(tr, q_score.XNUM, SEL.CORR_T))


# ------------------------------------------------------------------ in-fold steps

K = 5
STEPS = IN.InFold(cap_q=0.99, drop_leakers=True, corr_threshold=0.99,
                  feature_list=("age", "balance", "duration", "campaign", "previous", "price_k"), mi_k=3)
XCOLS = NUM + ["leak", "price_k"]


def _folded_extra(spark, d):
    """Raw training rows (not capped) with a leaker and a rescaled copy, fold-tagged."""
    tr = bank_train(spark, d).select("id", *NUM, "y", (F.col("y") * 1000 + F.col("age")).alias("leak"),
                                     (F.col("previous") / 1000.0).alias("price_k"))
    return S.stratified_kfold(tr, K)


def _capped_sql(c):
    return f"CASE WHEN {c} IS NULL THEN NULL ELSE least({G.dbl(c)}, q_{c}) END AS {c}"


_COPIES_SQL = (
    ", tx AS (SELECT id, " + ", ".join(NUM) + ", y, y * 1000 + age AS leak, previous / 1000.0 AS price_k FROM train),\n"
    "fo AS (" + G.folds("tx", K) + "),\n"
    f"co AS (SELECT fo.*, CAST(k AS INTEGER) AS fit_fold FROM fo, range(1, {K + 1}) t(k) WHERE k <> fold),\n"
    "ca AS (SELECT fit_fold, " + ", ".join(f"quantile_cont({G.dbl(c)}, 0.99) AS q_{c}" for c in STEPS.cap_cols) + " FROM co GROUP BY fit_fold),\n"
    "cp AS (SELECT co.* REPLACE (" + ", ".join(_capped_sql(c) for c in STEPS.cap_cols) + ") FROM co JOIN ca USING (fit_fold))\n")


@register("t05c_training_copies", sql_with(
    _COPIES_SQL + "SELECT id, fold, fit_fold, " + ", ".join(f"round({c}, 6) AS {c}" for c in STEPS.cap_cols) + " FROM cp"))
def t05c_training_copies(spark, d):
    """The training rows of every fold, each with the cap of the fold it trains."""
    copies, _ = IN.training_copies(_folded_extra(spark, d), STEPS, K)
    return copies.select("id", "fold", "fit_fold", *[r6(c).alias(c) for c in STEPS.cap_cols])


def _in_fold_sql() -> str:
    pairs = [(a, b) for i, a in enumerate(XCOLS) for b in XCOLS[i + 1:]]
    corr = " UNION ALL ".join(
        f"SELECT fit_fold, '{a}' AS a, '{b}' AS b, corr({G.dbl(a)}, {G.dbl(b)}) AS r FROM cp WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY fit_fold"
        for a, b in pairs)
    ps = ", ".join(str(i / M.MI_BINS) for i in range(M.MI_BINS + 1))
    listed = ", ".join(f"'{c}'" for c in STEPS.feature_list)
    discrete = ", ".join(f"'{c}'" for c in DISCRETE)
    return (
        _COPIES_SQL + ", lo AS (" + G.median_filled_long("cp", XCOLS, ["y", "fit_fold"], group="fit_fold") + "),\n"
        "names AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(XCOLS)) + ") v(i, c)),\n"
        "au AS (SELECT * FROM " + G.auc("lo", ["fit_fold", "feature"]) + "),\n"
        f"cr AS ({corr}),\n"
        f"k1 AS (SELECT CAST(f AS INTEGER) AS fit_fold, i, c FROM names, range(1, {K + 1}) t(f) WHERE NOT EXISTS "
        "(SELECT 1 FROM au WHERE au.fit_fold = f AND au.feature = c AND (auc >= 0.999 OR auc <= 0.001))),\n"
        "k2 AS (SELECT * FROM k1 WHERE NOT EXISTS (SELECT 1 FROM cr JOIN k1 o ON o.fit_fold = cr.fit_fold AND o.c = cr.b "
        f"WHERE cr.fit_fold = k1.fit_fold AND cr.a = k1.c AND abs(cr.r) >= {STEPS.corr_threshold})),\n"
        f"k3 AS (SELECT * FROM k2 WHERE c IN ({listed})),\n"
        f"st AS (SELECT fit_fold, feature, list_sort(list_distinct(quantile_cont(value, [{ps}]))) AS e FROM lo GROUP BY ALL),\n"
        f"bi AS (SELECT lo.fit_fold, lo.feature, y, CASE WHEN lo.feature IN ({discrete}) THEN value "
        "WHEN len(e) < 2 THEN NULL ELSE greatest(len(list_filter(e, lambda x: x < value)) - 1, 0) END AS v "
        "FROM lo JOIN st ON st.fit_fold = lo.fit_fold AND st.feature = lo.feature),\n"
        "jo AS (SELECT fit_fold, feature, v, y, count(*) AS nxy FROM bi WHERE v IS NOT NULL GROUP BY ALL),\n"
        "te AS (SELECT fit_fold, feature, nxy, sum(nxy) OVER (PARTITION BY fit_fold, feature) AS n, "
        "sum(nxy) OVER (PARTITION BY fit_fold, feature, v) AS nx, sum(nxy) OVER (PARTITION BY fit_fold, feature, y) AS ny FROM jo),\n"
        "mi AS (SELECT fit_fold, feature, greatest(sum(nxy / n * ln(nxy * n / (nx * ny))), 0.0) AS mi FROM te GROUP BY ALL),\n"
        "k4 AS (SELECT k3.fit_fold, c, row_number() OVER (PARTITION BY k3.fit_fold ORDER BY mi DESC, c) AS pos "
        "FROM k3 JOIN mi ON mi.fit_fold = k3.fit_fold AND mi.feature = c)\n"
        f"SELECT fit_fold AS fold, 'reduction' AS stage, 'corr' AS method, '{STEPS.corr_threshold}' AS param, "
        "CAST(row_number() OVER (PARTITION BY fit_fold ORDER BY i) AS INTEGER) AS pos, c AS column_name FROM k2\n"
        f"UNION ALL SELECT fit_fold, 'selection', 'mi', '{STEPS.mi_k}', CAST(pos AS INTEGER), c FROM k4 WHERE pos <= {STEPS.mi_k}")


@register("f08_in_fold_selection_log", sql_with(_in_fold_sql()))
def f08_in_fold_selection_log(spark, d):
    """F08 + S12: per fold cap -> leakers -> correlation reduction -> feature
    list -> MI selection on raw training rows, logged as kept-column rows."""
    return IN.fit_in_folds(_folded_extra(spark, d), XCOLS, STEPS, ROLES, K).log(spark)


VAR_STEPS = IN.InFold(cap_q=0.99, drop_leakers=True, var_threshold=10.0)


def _in_fold_variance_sql() -> str:
    spread = " UNION ALL ".join(f"SELECT fit_fold, {i} AS i, '{c}' AS c, var_samp({G.dbl(c)}) AS v FROM cp GROUP BY fit_fold" for i, c in enumerate(XCOLS))
    return (
        _COPIES_SQL + ", lo AS (" + G.median_filled_long("cp", XCOLS, ["y", "fit_fold"], group="fit_fold") + "),\n"
        "au AS (SELECT * FROM " + G.auc("lo", ["fit_fold", "feature"]) + "),\n"
        f"va AS ({spread})\n"
        f"SELECT fit_fold AS fold, 'reduction' AS stage, 'var' AS method, '{VAR_STEPS.var_threshold}' AS param, "
        "CAST(row_number() OVER (PARTITION BY fit_fold ORDER BY i) AS INTEGER) AS pos, c AS column_name FROM va "
        f"WHERE v > {VAR_STEPS.var_threshold} AND NOT EXISTS (SELECT 1 FROM au WHERE au.fit_fold = va.fit_fold AND au.feature = c AND (auc >= 0.999 OR auc <= 0.001))")


@register("f08_in_fold_variance_log", sql_with(_in_fold_variance_sql()))
def f08_in_fold_variance_log(spark, d):
    """F08 with the variance reduction: per fold cap -> leakers -> columns of low variance go, logged."""
    return IN.fit_in_folds(_folded_extra(spark, d), XCOLS, VAR_STEPS, ROLES, K).log(spark)


@register("l07_cv_with_in_fold_steps")
def l07_cv_with_in_fold_steps(spark, d):
    """L07 with all in-fold steps: the logistic model on the kept columns of
    each fold, NULLs filled with the train medians; fold metrics (E05)."""
    from tessera.operators import model as ML
    f = _folded_extra(spark, d)
    f = C.apply_median(f, C.fit_median(f, XCOLS))
    cv = ML.cross_validate(f, XCOLS, ML.LOGISTIC, None, ROLES, K, steps=STEPS)
    return cv.metrics.select("fold", r6("roc_auc").alias("roc_auc"))


# ------------------------------------------------------------------ M05, linear model

LINEAR = {c: float(i + 1) / 10 ** i for i, c in enumerate(NUM)}


@register("m05_linear_shap", sql_with(
    ", l AS (" + G.median_filled_long("train", NUM, ["y"]) + "),\n"
    "m AS (SELECT feature, avg(value) AS m FROM l GROUP BY feature),\n"
    "b AS (SELECT * FROM (VALUES " + ", ".join(f"('{c}', {v!r})" for c, v in LINEAR.items()) + ") v(feature, b))\n"
    "SELECT l.feature, round(avg(abs(b * (value - m))), 6) AS shap_mean_abs "
    "FROM l JOIN m ON m.feature = l.feature JOIN b ON b.feature = l.feature GROUP BY l.feature"))
def m05_linear_shap(spark, d):
    """The closed form over all training rows, for given coefficients."""
    from tessera.operators.explain import linear_shap
    tr = bank_train(spark, d).select(*NUM)
    return _round_all(linear_shap(C.apply_median(tr, C.fit_median(tr, NUM)), LINEAR))
