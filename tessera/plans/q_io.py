"""Registered source/sink queries (S01-S04, S07-S09) with oracles: each writes
through Spark's writers into the shared checkpoint folder and reads back."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tessera.operators import combine as J
from tessera.plans.registry import register
from tessera.session import checkpoint_dir
from tessera.sources import io as IO
from tessera.functions.exprs import r6
from tessera.plans import sqlgen as G
from tessera.sources.bank import bank_test, bank_train, bank_view, sql_with, table

NUM = ["age", "balance", "duration", "campaign", "previous"]


def _scratch(spark, name):
    return os.path.join(checkpoint_dir(spark), "io", uuid.uuid4().hex, name)


@register("s01_s03_csv_round_trip", sql_with("SELECT * FROM dtrain"))
def s01_s03_csv_round_trip(spark, d):
    tr = bank_train(spark, d, dirty=True)
    p = _scratch(spark, "train.csv")
    IO.write_csv(tr, p)
    return IO.read_table(spark, p, schema=tr.schema)


@register("s02_s04_parquet_round_trip", sql_with("SELECT * FROM train"))
def s02_s04_parquet_round_trip(spark, d):
    p = _scratch(spark, "combined.parquet")
    IO.write_parquet(bank_view(spark, d), p, partition_by=("split",))
    back = IO.read_table(spark, p)
    return IO.split_scan(back, "train").select(*bank_train(spark, d).columns)


@register("s07_external_csv_join", sql_with("""
, e1 AS (SELECT l_orderkey AS id, round(avg(l_discount), 6) AS discount, count(*) AS campaign FROM lineitem GROUP BY l_orderkey)
SELECT b.id, b.split, b.campaign AS campaign_x, e1.discount, CAST(e1.campaign AS INTEGER) AS campaign_y
FROM bank b LEFT JOIN e1 ON e1.id = b.id"""))
def s07_external_csv_join(spark, d):
    folder = _scratch(spark, "external")
    li = table(spark, d, "lineitem")
    e1 = li.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.round(F.avg("l_discount"), 6).alias("discount"), F.count(F.lit(1)).alias("campaign"))
    IO.write_csv(e1, os.path.join(folder, "lines.csv"))
    IO.write_csv(table(spark, d, "nation").select("n_nationkey", "n_name"), os.path.join(folder, "nokey.csv"))
    ext = [df for _, df in IO.scan_external_csvs(spark, folder)]
    comb = bank_view(spark, d).select("id", "split", "campaign")
    return J.join_external(comb, ext)


@register("s08_warehouse_refresh", sql_with("SELECT * FROM train"))
def s08_warehouse_refresh(spark, d):
    """Create a schema at a shared location, replace its train/test tables,
    read the train table back through the catalog."""
    db = "bank_" + uuid.uuid4().hex[:12]
    IO.refresh_warehouse(spark, bank_train(spark, d), bank_test(spark, d), database=db,
                         location=_scratch(spark, "warehouse"))
    return spark.table(f"{db}.train")


@register("s09_bi_export", sql_with(
    ", l AS (" + G.median_filled_long("train", NUM, ["y"]) + ")\n"
    "SELECT feature, round(auc, 6) AS auc, round(abs(auc - 0.5), 6) AS auc_dev FROM " + G.auc("l", ["feature"])))
def s09_bi_export(spark, d):
    """Export train, test and the five score reports to one folder as CSV; all seven are read back and held against
    what was exported, the AUC report is returned."""
    from tessera.operators import score as M
    from tessera.roles import Roles
    folder = _scratch(spark, "bi")
    tr = bank_train(spark, d)
    rep = M.univariate_auc(tr, Roles()).select("feature", r6("auc").alias("auc"), r6("auc_dev").alias("auc_dev"))
    from tessera.operators import model as ML
    from tessera.operators.explain import mean_abs_shap
    # one boosted model (400 rounds) for both of its reports; missing values need no fill
    model = ML.fit_table(ML.Profile("importance", "gbt", rounds=400, depth=6, rate=0.05, weighted=False), tr.select("id", "y", *NUM), NUM).model
    IO.export_reports({
        "train": tr, "test": bank_test(spark, d), "univariate_auc": rep,
        "mutual_information": M.mutual_information(tr, Roles(discrete=("campaign",))),
        "target_correlation": M.target_correlation(tr, Roles()),
        "model_importance": spark.createDataFrame(list(zip(NUM, model.importance())), "feature string, importance double"),
        "shap_importance": mean_abs_shap(tr, model)}, folder)
    back = {n: IO.read_csv(spark, os.path.join(folder, n)) for n in ("train", "test", "mutual_information", "target_correlation", "model_importance", "shap_importance")}
    if {n: df.count() for n, df in back.items() if n not in ("train", "test")} != {n: len(NUM) for n in back if n not in ("train", "test")}:
        raise ValueError("a report lost rows in the export")
    if any(back[n].count() != df.count() or back[n].columns != df.columns for n, df in (("train", tr), ("test", bank_test(spark, d)))):
        raise ValueError("a table lost rows or columns in the export")
    return IO.read_csv(spark, os.path.join(folder, "univariate_auc"), schema=rep.schema)
