"""Registered combine queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.exprs import r6
from tessera.operators import combine as J
from tessera.plans.registry import register
from tessera.sources.bank import bank_test, bank_train, bank_view, table, sql_with

FEATS = sorted(["age", "job", "marital", "education", "contact", "balance", "duration", "campaign", "previous", "id"])


@register("u01_align_union", sql_with(
    "SELECT " + ", ".join(FEATS) + ", y, 'train' AS split FROM train UNION ALL SELECT "
    + ", ".join(FEATS) + ", CAST(NULL AS INTEGER) AS y, 'test' AS split FROM test"))
def u01_align_union(spark, d):
    return J.align_and_union(bank_train(spark, d), bank_test(spark, d))


def _ext_lines(spark, d):
    """External table 1: per-order line facts keyed by id (overlaps on
    'campaign')."""
    li = table(spark, d, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.round(F.avg("l_discount"), 6).alias("discount"), F.count(F.lit(1)).alias("campaign"))


def _ext_parts(spark, d):
    """External table 2: one row per line (duplicate keys multiply rows)."""
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"),
                     F.col("l_returnflag").alias("flag"))


def _ext_nokey(spark, d):
    """External table 3: no key column -> skipped."""
    return table(spark, d, "nation").select("n_nationkey", "n_name")


@register("j01_join_external", sql_with("""
, e1 AS (SELECT l_orderkey AS id, round(avg(l_discount), 6) AS discount, count(*) AS campaign FROM lineitem GROUP BY l_orderkey),
e2 AS (SELECT l_orderkey AS id, l_linenumber AS line, l_returnflag AS flag FROM lineitem)
SELECT b.id, b.split, b.campaign AS campaign_x, e1.discount, e1.campaign AS campaign_y, e2.line, e2.flag
FROM bank b LEFT JOIN e1 ON e1.id = b.id LEFT JOIN e2 ON e2.id = b.id"""))
def j01_join_external(spark, d):
    comb = bank_view(spark, d).select("id", "split", "campaign")
    return J.join_external(comb, [_ext_lines(spark, d), _ext_nokey(spark, d), _ext_parts(spark, d)])


def _pred_a(spark, d):
    b = bank_view(spark, d).where(F.col("split") == "test")
    return b.select("id", (F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("previous") - 380000.0) / 50000.0))).alias("y"))


def _pred_b(spark, d):
    b = bank_view(spark, d).where((F.col("split") == "test") & F.col("duration").isNotNull())
    return b.select("id", (F.lit(1.2) / (F.lit(1.0) + F.exp(-F.col("balance") / 3000.0)) - 0.1).alias("score"))


_PRED_SQL = """
, pa AS (SELECT id, 1.0 / (1.0 + exp(-(previous - 380000.0) / 50000.0)) AS y FROM bank WHERE split = 'test'),
pb AS (SELECT id, 1.2 / (1.0 + exp(-balance / 3000.0)) - 0.1 AS y FROM bank WHERE split = 'test' AND duration IS NOT NULL)
"""


@register("e09_ensemble_mean", sql_with(_PRED_SQL + """
SELECT coalesce(pa.id, pb.id) AS id,
  round((coalesce(pa.y, 0) + coalesce(pb.y, 0)) / ((pa.y IS NOT NULL)::INT + (pb.y IS NOT NULL)::INT), 6) AS y
FROM pa FULL OUTER JOIN pb ON pa.id = pb.id"""))
def e09_ensemble_mean(spark, d):
    e = J.ensemble_mean([_pred_a(spark, d), _pred_b(spark, d)])
    return e.select("id", r6("y").alias("y"))


@register("j02_side_by_side", sql_with(_PRED_SQL + """
SELECT coalesce(pa.id, pb.id) AS id, round(pa.y, 6) AS y_0, round(pb.y, 6) AS y_1
FROM pa FULL OUTER JOIN pb ON pa.id = pb.id"""))
def j02_side_by_side(spark, d):
    w = J.side_by_side([_pred_a(spark, d), _pred_b(spark, d)])
    return w.select("id", r6("y_0").alias("y_0"), r6("y_1").alias("y_1"))


@register("e10_submission", sql_with(_PRED_SQL + """
SELECT t.id, round(greatest(least(e.y, 1.0), 0.0), 6) AS y FROM test t JOIN (
  SELECT coalesce(pa.id, pb.id) AS id,
         (coalesce(pa.y, 0) + coalesce(pb.y, 0)) / ((pa.y IS NOT NULL)::INT + (pb.y IS NOT NULL)::INT) AS y
  FROM pa FULL OUTER JOIN pb ON pa.id = pb.id) e ON e.id = t.id"""))
def e10_submission(spark, d):
    sample = bank_test(spark, d).select("id")
    ens = J.ensemble_mean([_pred_a(spark, d), _pred_b(spark, d)])
    sub = J.submission(sample, ens)
    return sub.select("id", r6("y").alias("y"))
