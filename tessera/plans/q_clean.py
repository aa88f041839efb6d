"""Registered cleaning queries (T01-T08, T14, S10) with DuckDB oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.functions.exprs import r6
from tessera.operators import clean as C
from tessera.plans.registry import register
from tessera.roles import Roles
from tessera.session import checkpoint_dir
from tessera.sources.io import load_params, save_params
from tessera.sources.bank import bank_materialized, bank_train, bank_test, bank_view, with_text_nulls, sql_with

NUM = ["age", "balance", "duration", "campaign", "previous"]
CAT = ["job", "marital", "education", "contact"]
ROLES = Roles()
# The category withheld from fitting to create unseen text.
UNSEEN_JOB = "MACHINERY"
CAP_Q = 0.99


def _round(df, cols):
    return df.select(*[r6(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def _dbl(c):
    return f"CAST({c} AS DOUBLE)"


def _rnd(e, alias):
    return f"round({e}, 6) AS {alias}"


# ------------------------------------------------------------------ T01

@register("t01_impute_median", sql_with(", " + ", ".join(
    [f"m_{c} AS (SELECT quantile_cont({_dbl(c)}, 0.5) AS v FROM train)" for c in NUM]) + "\nSELECT id, " +
    ", ".join(_rnd(f"coalesce({_dbl(c)}, (SELECT v FROM m_{c}))", c) for c in NUM) + " FROM train"))
def t01_impute_median(spark, d):
    tr = bank_train(spark, d).select("id", *NUM)
    return _round(C.apply_median(tr, C.fit_median(tr, NUM)), NUM)


# ------------------------------------------------------------------ T02

def _mode_sql(src, c):
    return (f"(SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC, {c} LIMIT 1)")


@register("t02_impute_mode", sql_with("SELECT id, " + ", ".join(
    f"coalesce({c}, {_mode_sql('dtrain', c)}) AS {c}" for c in CAT) + " FROM dtrain"))
def t02_impute_mode(spark, d):
    tr = bank_train(spark, d, dirty=True).select("id", *CAT)
    return C.apply_mode(tr, C.fit_mode(tr, CAT))


# ------------------------------------------------------------------ T04

def _iqr_ctes(src, cols, prefix="b"):
    return ", ".join(
        f"{prefix}_{c} AS (SELECT q[1] - 1.5 * (q[2] - q[1]) AS lo, q[2] + 1.5 * (q[2] - q[1]) AS hi "
        f"FROM (SELECT quantile_cont({_dbl(c)}, [0.25, 0.75]) AS q FROM {src}))" for c in cols)


def _clip_sql(e, lo, hi):
    return f"CASE WHEN {e} IS NULL THEN NULL ELSE greatest(least({e}, {hi}), {lo}) END"


@register("t04_cap_iqr", sql_with(", " + _iqr_ctes("train", NUM) + "\nSELECT id, " + ", ".join(
    _rnd(_clip_sql(_dbl(c), f"(SELECT lo FROM b_{c})", f"(SELECT hi FROM b_{c})"), c) for c in NUM)
    + " FROM train"))
def t04_cap_iqr(spark, d):
    tr = bank_train(spark, d).select("id", *NUM)
    return _round(C.apply_iqr(tr, C.fit_iqr(tr, NUM)), NUM)


# ------------------------------------------------------------------ T05a / T05b

def _cap_sql(e, cap):
    return f"CASE WHEN {e} IS NULL THEN NULL ELSE least({e}, {cap}) END"


@register("t05a_cap_quantile", sql_with(
    f", cq AS (SELECT quantile_cont({_dbl('duration')}, {CAP_Q}) AS d, quantile_cont({_dbl('campaign')}, {CAP_Q}) AS c FROM bank)\n"
    "SELECT id, " + _rnd(_cap_sql(_dbl("duration"), "(SELECT d FROM cq)"), "duration") + ", "
    + _rnd(_cap_sql(_dbl("campaign"), "(SELECT c FROM cq)"), "campaign") + " FROM bank"))
def t05a_cap_quantile(spark, d):
    b = bank_view(spark, d).select("id", "duration", "campaign")
    return _round(C.apply_cap(b, C.fit_cap(b, ["duration", "campaign"], CAP_Q)), ["duration", "campaign"])


@register("t05b_cap_train_fit", sql_with(
    f", cq AS (SELECT quantile_cont({_dbl('duration')}, {CAP_Q}) AS d, quantile_cont({_dbl('campaign')}, {CAP_Q}) AS c FROM train)\n"
    "SELECT id, split, " + _rnd(_cap_sql(_dbl("duration"), "(SELECT d FROM cq)"), "duration") + ", "
    + _rnd(_cap_sql(_dbl("campaign"), "(SELECT c FROM cq)"), "campaign") + " FROM bank"))
def t05b_cap_train_fit(spark, d):
    b = bank_view(spark, d).select("id", "split", "duration", "campaign")
    caps = C.fit_cap(bank_train(spark, d), ["duration", "campaign"], CAP_Q)
    return _round(C.apply_cap(b, caps), ["duration", "campaign"])


# ------------------------------------------------------------------ T06

@register("t06_log1p", sql_with(
    "SELECT id, round(CASE WHEN balance > -1 THEN ln(1 + balance) END, 6) AS balance FROM bank"))
def t06_log1p(spark, d):
    b = bank_view(spark, d).select("id", "balance")
    return _round(C.apply_log1p(b, ["balance"]), ["balance"])


# ------------------------------------------------------------------ T07

def _enc_ctes(fit_src, cols):
    return ", ".join(
        f"d_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM "
        f"(SELECT DISTINCT coalesce({c}, 'nan') AS v FROM {fit_src}))" for c in cols)


def _enc_select(src, cols, keep):
    joins = " ".join(f"LEFT JOIN d_{c} ON d_{c}.v = coalesce({src}.{c}, 'nan')" for c in cols)
    sel = ", ".join([f"{src}.{k}" for k in keep] + [f"CAST(coalesce(d_{c}.code, 0) AS INTEGER) AS {c}" for c in cols])
    return f"SELECT {sel} FROM {src} {joins}"


@register("t07_encode_ordinal", sql_with(
    f", fit AS (SELECT * FROM dtrain WHERE job <> '{UNSEEN_JOB}'), " + _enc_ctes("fit", CAT) + "\n"
    + _enc_select("dtest", CAT, ["id"])))
def t07_encode_ordinal(spark, d):
    fit = bank_train(spark, d, dirty=True).where(F.col("job") != UNSEEN_JOB)
    codes = C.fit_ordinal(fit, CAT)
    return C.apply_ordinal(bank_test(spark, d, dirty=True).select("id", *CAT), codes)


# ------------------------------------------------------------------ T08

@register("t08_standardize", sql_with(", " + ", ".join(
    f"s_{c} AS (SELECT avg({_dbl(c)}) AS m, CASE WHEN coalesce(stddev_pop({_dbl(c)}), 0) = 0 THEN 1 "
    f"ELSE stddev_pop({_dbl(c)}) END AS s FROM train)" for c in NUM) + "\nSELECT id, " + ", ".join(
    _rnd(f"({_dbl(c)} - (SELECT m FROM s_{c})) / (SELECT s FROM s_{c})", c) for c in NUM) + " FROM train"))
def t08_standardize(spark, d):
    tr = bank_train(spark, d).select("id", *NUM)
    return _round(C.apply_standard(tr, C.fit_standard(tr, NUM)), NUM)


# ------------------------------------------------------------------ T14

def _chain_sql() -> str:
    """The whole clean chain, each step fitted on the previous step's
    training rows, applied to train and test (dirty bank view)."""
    cte = []
    # step 1: impute (median numeric, mode text), fitted on dtrain
    cte += [f"m_{c} AS (SELECT quantile_cont({_dbl(c)}, 0.5) AS v FROM dtrain)" for c in NUM]
    s1 = ", ".join([f"coalesce({_dbl(c)}, (SELECT v FROM m_{c})) AS {c}" for c in NUM]
                   + [f"coalesce({c}, {_mode_sql('dtrain', c)}) AS {c}" for c in CAT])
    cte.append(f"s1 AS (SELECT id, y, 'train' AS split, {s1} FROM dtrain "
               f"UNION ALL SELECT id, NULL AS y, 'test' AS split, {s1} FROM dtest)")
    # step 2: IQR cap fitted on imputed train
    cte.append(_iqr_ctes("(SELECT * FROM s1 WHERE split = 'train')", NUM))
    s2 = ", ".join(_clip_sql(c, f"(SELECT lo FROM b_{c})", f"(SELECT hi FROM b_{c})") + f" AS {c}" for c in NUM)
    cte.append(f"s2 AS (SELECT id, y, split, {s2}, {', '.join(CAT)} FROM s1)")
    # step 3: quantile cap on duration/campaign, log1p balance
    cte.append(f"cq AS (SELECT quantile_cont(duration, {CAP_Q}) AS d, quantile_cont(campaign, {CAP_Q}) AS c "
               "FROM s2 WHERE split = 'train')")
    cte.append("s3 AS (SELECT id, y, split, age, CASE WHEN balance > -1 THEN ln(1 + balance) END AS balance, "
               + _cap_sql("duration", "(SELECT d FROM cq)") + " AS duration, "
               + _cap_sql("campaign", "(SELECT c FROM cq)") + " AS campaign, previous, "
               + ", ".join(CAT) + " FROM s2)")
    # step 4: ordinal codes fitted on train
    cte.append(", ".join(
        f"d_{c} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM "
        f"(SELECT DISTINCT {c} AS v FROM s3 WHERE split = 'train'))" for c in CAT))
    joins = " ".join(f"LEFT JOIN d_{c} ON d_{c}.v = s3.{c}" for c in CAT)
    cte.append("s4 AS (SELECT s3.id, s3.y, s3.split, " + ", ".join(f"s3.{c}" for c in NUM) + ", "
               + ", ".join(f"CAST(coalesce(d_{c}.code, 0) AS DOUBLE) AS {c}" for c in CAT) + f" FROM s3 {joins})")
    # step 5: standardise numeric and codes, fitted on train
    allc = NUM + CAT
    cte.append(", ".join(
        f"z_{c} AS (SELECT avg({c}) AS m, CASE WHEN coalesce(stddev_pop({c}), 0) = 0 THEN 1 "
        f"ELSE stddev_pop({c}) END AS s FROM s4 WHERE split = 'train')" for c in allc))
    body = "SELECT id, y, split, " + ", ".join(
        _rnd(f"({c} - (SELECT m FROM z_{c})) / (SELECT s FROM z_{c})", c) for c in allc) + " FROM s4"
    return sql_with(", " + ",\n".join(cte) + "\n" + body)


@register("t14_clean_chain", _chain_sql())
def t14_clean_chain(spark, d):
    base = bank_materialized(spark, d)
    tr = bank_train(spark, d, dirty=True, base=base)
    te = bank_test(spark, d, dirty=True, base=base)
    st = C.fit_clean(tr, ROLES, cap_pct=CAP_Q, log1p_balance=True)
    a = C.apply_clean(tr, st, ROLES).withColumn("split", F.lit("train"))
    b = C.apply_clean(te, st, ROLES).withColumn("split", F.lit("test")).withColumn("y", F.lit(None).cast("int"))
    out = a.unionByName(b)
    return _round(out.select("id", "y", "split", *NUM, *CAT), NUM + CAT)


# ------------------------------------------------------------------ S10

@register("s10_clean_params")
def s10_clean_params(spark, d):
    """Fitted state of the chain as a table, saved and read back (rows-only check)."""
    st = C.fit_clean(bank_train(spark, d, dirty=True), ROLES, cap_pct=CAP_Q, log1p_balance=True)
    path = f"{checkpoint_dir(spark)}/params/{uuid.uuid4().hex}"
    save_params(C.params_frame(spark, st), path)
    return load_params(spark, path)


@register("s10_reloaded_state", "SELECT * FROM (" + _chain_sql() + ") WHERE split = 'test'")
def s10_reloaded_state(spark, d):
    """The chain's state saved, read back, rebuilt and applied to the test rows."""
    st = C.clean_state(s10_clean_params(spark, d))
    b = C.apply_clean(bank_test(spark, d, dirty=True), st, ROLES).withColumn("split", F.lit("test")).withColumn("y", F.lit(None).cast("int"))
    return _round(b.select("id", "y", "split", *NUM, *CAT), NUM + CAT)


_ = (with_text_nulls,)
