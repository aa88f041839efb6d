"""Registered projection, predicate, sort and limit queries (P07, P08, P10,
O01, O02), each over the whole training part of the bank view."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.exprs import case_by, finite, int_label, r6, unpivot
from tessera.operators import evaluate as EV
from tessera.operators import profile as P
from tessera.operators import score as M
from tessera.plans import q_score
from tessera.plans.registry import ORACLES, register
from tessera.roles import Roles
from tessera.sources.bank import bank_train, sql_with

NUM = ["age", "balance", "duration", "campaign", "previous"]
ROLES = Roles()
TOP_ROWS = 20

# Keys whose balance is replaced by NaN / +inf / -inf to exercise P07.
NAN_MOD, POS_INF_MOD, NEG_INF_MOD = 11, 13, 19


@register("p07_nan_inf_to_null", sql_with(f"""
SELECT id, round(CASE WHEN id % {NAN_MOD} = 0 OR id % {POS_INF_MOD} = 0 OR id % {NEG_INF_MOD} = 0 THEN NULL
                      ELSE CAST(balance AS DOUBLE) END, 6) AS balance
FROM train"""))
def p07_nan_inf_to_null(spark, d):
    key = F.col("id")
    raw = (F.when(key % NAN_MOD == 0, F.lit(float("nan")))
           .when(key % POS_INF_MOD == 0, F.lit(float("inf")))
           .when(key % NEG_INF_MOD == 0, F.lit(float("-inf")))
           .otherwise(F.col("balance").cast("double")))
    x = bank_train(spark, d).select("id", raw.alias("balance"))
    return x.select("id", r6(finite("balance")).alias("balance"))


@register("p08_label_cast", sql_with("SELECT id, y FROM train"))
def p08_label_cast(spark, d):
    text = bank_train(spark, d).select("id", F.col("y").cast("string").alias("y"))
    return text.select("id", int_label("y").alias("y"))


_CAST = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUM)
_Q = ", ".join(f"quantile_cont({c}, [0.25, 0.75]) AS {c}" for c in NUM)


@register("p10_iqr_outlier_rows", sql_with(f"""
, q AS (SELECT {_Q} FROM train),
b AS (UNPIVOT q ON COLUMNS(*) INTO NAME column_name VALUE qs),
bounds AS (SELECT column_name, qs[1] - 1.5 * (qs[2] - qs[1]) AS lo, qs[2] + 1.5 * (qs[2] - qs[1]) AS hi FROM b),
long AS (UNPIVOT (SELECT id, {_CAST} FROM train) ON {", ".join(NUM)} INTO NAME column_name VALUE v)
SELECT long.id, long.column_name, round(long.v, 6) AS value
FROM long JOIN bounds ON long.column_name = bounds.column_name
WHERE long.v < bounds.lo OR long.v > bounds.hi"""))
def p10_iqr_outlier_rows(spark, d):
    """Every (row, column) cell outside its column's IQR fence: the fences
    are one fit job, the predicate a projection over the long table."""
    tr = bank_train(spark, d)
    bounds = P.iqr_bounds(tr, NUM)
    long = unpivot(tr, NUM, ids=["id"])
    lo = case_by(F.col("feature"), {c: b[0] for c, b in bounds.items() if b[0] is not None})
    hi = case_by(F.col("feature"), {c: b[1] for c, b in bounds.items() if b[1] is not None})
    return (long.where((F.col("value") < lo) | (F.col("value") > hi))
            .select("id", F.col("feature").alias("column_name"), r6("value").alias("value")))


_M03_FINAL = "SELECT feature, round(abs(corr), 6) AS corr_abs, round(corr, 6) AS corr FROM r"
assert _M03_FINAL in ORACLES["m03_target_correlation"]
_ = q_score


@register("o01_sorted_report", ORACLES["m03_target_correlation"].replace(
    _M03_FINAL, "SELECT feature, corr_abs, corr, row_number() OVER (ORDER BY corr_abs DESC, feature) AS rank "
                "FROM (" + _M03_FINAL + ")"))
def o01_sorted_report(spark, d):
    rep = M.target_correlation(bank_train(spark, d), ROLES)
    rep = rep.select("feature", r6("corr_abs").alias("corr_abs"), r6("corr").alias("corr"))
    return EV.ranked(rep, "corr_abs")


@register("o02_top_rows", sql_with(
    f"SELECT id, round(previous, 6) AS previous, y FROM train ORDER BY previous DESC, id LIMIT {TOP_ROWS}"))
def o02_top_rows(spark, d):
    """Head of a sort over the whole table: the planner runs it as a
    per-partition top-k followed by one merge of k rows per partition
    (TakeOrderedAndProject), never a full sort."""
    tr = bank_train(spark, d)
    return (tr.orderBy(F.desc("previous"), F.asc("id")).limit(TOP_ROWS)
            .select("id", r6("previous").alias("previous"), "y"))
