"""Registered split queries (X01-X04, T05c) with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.exprs import r6
from tessera.operators import features as FE
from tessera.operators import split as S
from tessera.plans import sqlgen as G
from tessera.plans.registry import register
from tessera.sources.bank import bank_train, sql_with

K = 5
HOLDOUT = 0.2
SAMPLE_N = 5000
CAP_Q = 0.99


@register("x01_stratified_holdout", sql_with(f"""
SELECT id, y, CASE WHEN rn <= ceil(n * {HOLDOUT}) THEN 'valid' ELSE 'train' END AS part FROM (
  SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY md5('{G.SEED}|' || CAST(id AS VARCHAR)), id) AS rn,
         count(*) OVER (PARTITION BY y) AS n FROM train)"""))
def x01_stratified_holdout(spark, d):
    return S.stratified_holdout(bank_train(spark, d).select("id", "y"), HOLDOUT)


@register("x02_stratified_kfold", sql_with(f"SELECT id, y, fold FROM ({G.folds('train', K)})"))
def x02_stratified_kfold(spark, d):
    return S.stratified_kfold(bank_train(spark, d).select("id", "y"), K)


@register("x03_kfold_unshuffled", sql_with(f"SELECT id, y, fold FROM ({G.folds('train', K, shuffle=False)})"))
def x03_kfold_unshuffled(spark, d):
    return S.stratified_kfold(bank_train(spark, d).select("id", "y"), K, shuffle=False)


@register("x04_sample_rows", sql_with(
    f"SELECT id, y FROM train ORDER BY md5('{G.SEED}|' || CAST(id AS VARCHAR)), id LIMIT {SAMPLE_N}"))
def x04_sample_rows(spark, d):
    return S.sample_rows(bank_train(spark, d).select("id", "y"), SAMPLE_N)


@register("t05c_cap_in_fold", sql_with(f""", f AS ({G.folds('train', K)}),
caps AS (SELECT ff.fold AS fit_fold, quantile_cont({G.dbl('duration')}, {CAP_Q}) AS d,
                quantile_cont({G.dbl('campaign')}, {CAP_Q}) AS c
         FROM f JOIN (SELECT DISTINCT fold FROM f) ff ON f.fold <> ff.fold GROUP BY ff.fold)
SELECT id, fold,
  round(CASE WHEN duration IS NULL THEN NULL ELSE least({G.dbl('duration')}, caps.d) END, 6) AS duration,
  round(CASE WHEN campaign IS NULL THEN NULL ELSE least({G.dbl('campaign')}, caps.c) END, 6) AS campaign
FROM f JOIN caps ON caps.fit_fold = f.fold"""))
def t05c_cap_in_fold(spark, d):
    f = S.stratified_kfold(bank_train(spark, d).select("id", "y", "duration", "campaign"), K)
    copies = S.fold_training_copies(f, K)
    caps = FE.fit_cap_by_group(copies, ["duration", "campaign"], CAP_Q, "fit_fold")
    out = FE.apply_cap_by_group(f, caps, "fold")
    return out.select("id", "fold", r6("duration").alias("duration"), r6("campaign").alias("campaign"))


_ = F
