"""The bank-shaped labelled table over the driver's TPC-H-ish tables.

The reference works on one bank-customer table with a binary target ``y``.
The given data has none, so every query starts from this view (FIXTURES.md
section 3). It is an ordinary Spark plan over the parquet tables: an
aggregate of lineitem per order, joined to orders, customer, nation and
region.

Plan shape at scale: lineitem is reduced by ``l_orderkey`` (partial
aggregation before the shuffle), orders joins it on the same key, customer
joins on ``c_custkey`` (both shuffle joins chosen by the planner), and only
nation (25 rows) and region (5 rows) -- fixed-size dimension tables -- are
broadcast.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# The bank view's definition (label rule, split rule, age rule).
LABEL_PRICE = 380000
LABEL_KEY_MOD = 7
TEST_KEY_MOD = 5
AGE_BASE, AGE_SPAN = 18, 60
DIRTY_KEY_MOD = 17


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def bank_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, age, job, marital, education, contact, balance, duration,
    campaign, previous, y, split -- one row per order."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    li = (table(spark, sf_dir, "lineitem")
          .groupBy("l_orderkey")
          .agg(F.sum("l_quantity").alias("q"), F.count(F.lit(1)).alias("n")))

    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    j = (orders
         .join(customer, orders.o_custkey == customer.c_custkey)
         .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
         .join(li, orders.o_orderkey == li.l_orderkey, "left"))
    label = F.when((F.col("o_totalprice") > LABEL_PRICE)
                   != (F.col("o_orderkey") % LABEL_KEY_MOD == 0), 1).otherwise(0)
    return j.select(
        F.col("o_orderkey").alias("id"),
        (F.lit(AGE_BASE) + F.col("o_custkey") % AGE_SPAN).alias("age"),
        F.col("c_mktsegment").alias("job"),
        F.col("o_orderstatus").alias("marital"),
        F.col("o_orderpriority").alias("education"),
        F.col("r_name").alias("contact"),
        F.col("c_acctbal").alias("balance"),
        F.col("q").alias("duration"),
        F.col("n").alias("campaign"),
        F.col("o_totalprice").alias("previous"),
        label.alias("y"),
        F.when(F.col("o_orderkey") % TEST_KEY_MOD == 0, "test").otherwise("train").alias("split"),
    )


def with_text_nulls(df: DataFrame, column: str = "education", key: str = "id") -> DataFrame:
    """Inject text nulls (FIXTURES.md): every 17th key loses its value."""
    return df.withColumn(column, F.when(F.col(key) % DIRTY_KEY_MOD == 0, F.lit(None))
                         .otherwise(F.col(column)))


def bank_materialized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bank view written once (Parquet, shared checkpoint folder) for
    plans that read it in several passes."""
    from tessera.session import materialize
    return materialize(bank_view(spark, sf_dir), "bank")


def bank_train(spark: SparkSession, sf_dir: str, dirty: bool = False, base: DataFrame | None = None) -> DataFrame:
    """Training rows of the bank view without the split flag."""
    from tessera.sources.io import split_scan
    b = base if base is not None else bank_view(spark, sf_dir)
    if dirty:
        b = with_text_nulls(b)
    return split_scan(b, "train")


def bank_test(spark: SparkSession, sf_dir: str, dirty: bool = False, base: DataFrame | None = None) -> DataFrame:
    from tessera.sources.io import split_scan
    b = base if base is not None else bank_view(spark, sf_dir)
    if dirty:
        b = with_text_nulls(b)
    return split_scan(b, "test").drop("y")


# The same view as ANSI SQL for the DuckDB oracle.
BANK_SQL = f"""
li AS (SELECT l_orderkey, sum(l_quantity) AS q, count(*) AS n FROM lineitem GROUP BY l_orderkey),
bank AS (
  SELECT o_orderkey AS id, {AGE_BASE} + (o_custkey % {AGE_SPAN}) AS age,
         c_mktsegment AS job, o_orderstatus AS marital, o_orderpriority AS education, r_name AS contact,
         c_acctbal AS balance, q AS duration, n AS campaign, o_totalprice AS previous,
         CASE WHEN (o_totalprice > {LABEL_PRICE}) <> (o_orderkey % {LABEL_KEY_MOD} = 0) THEN 1 ELSE 0 END AS y,
         CASE WHEN o_orderkey % {TEST_KEY_MOD} = 0 THEN 'test' ELSE 'train' END AS split
  FROM orders JOIN customer ON o_custkey = c_custkey
              JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
              LEFT JOIN li ON l_orderkey = o_orderkey),
bank_dirty AS (
  SELECT * REPLACE (CASE WHEN id % {DIRTY_KEY_MOD} = 0 THEN NULL ELSE education END AS education) FROM bank),
train AS (SELECT * EXCLUDE (split) FROM bank WHERE split = 'train'),
test AS (SELECT * EXCLUDE (split, y) FROM bank WHERE split = 'test'),
dtrain AS (SELECT * EXCLUDE (split) FROM bank_dirty WHERE split = 'train'),
dtest AS (SELECT * EXCLUDE (split, y) FROM bank_dirty WHERE split = 'test')
"""


def sql_with(body: str) -> str:
    """Prefix a query body with the bank CTEs."""
    return "WITH " + BANK_SQL.strip() + "\n" + body
