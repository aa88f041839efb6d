"""Registered profiling and validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.exprs import r6
from tessera.operators import profile as P
from tessera.plans.registry import register
from tessera.roles import Roles
from tessera.sources.bank import bank_materialized, bank_train, sql_with

NUM = ["age", "balance", "duration", "campaign", "previous"]
ROLES = Roles()


@register("s06_split_scan", sql_with("SELECT * FROM train"))
def s06_split_scan(spark, d):
    return bank_train(spark, d)


@register("a01_missing_counts", sql_with("""
SELECT column_name, missing_count FROM (
  UNPIVOT (SELECT count(*) - count(id) AS id, count(*) - count(age) AS age, count(*) - count(job) AS job,
                  count(*) - count(marital) AS marital, count(*) - count(education) AS education,
                  count(*) - count(contact) AS contact, count(*) - count(balance) AS balance,
                  count(*) - count(duration) AS duration, count(*) - count(campaign) AS campaign,
                  count(*) - count(previous) AS previous, count(*) - count(y) AS y FROM dtrain)
  ON COLUMNS(*) INTO NAME column_name VALUE missing_count)
WHERE missing_count > 0"""))
def a01_missing_counts(spark, d):
    return P.missing_counts(bank_train(spark, d, dirty=True))


@register("a02_duplicate_rows", sql_with("""
SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS c FROM dtrain GROUP BY job, marital, education, contact)"""))
def a02_duplicate_rows(spark, d):
    return P.duplicate_rows(bank_train(spark, d, dirty=True).select("job", "marital", "education", "contact"))


@register("a04_class_distribution", sql_with("""
SELECT y, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS pct FROM train GROUP BY y"""))
def a04_class_distribution(spark, d):
    return P.class_distribution(bank_train(spark, d)).withColumn("pct", r6("pct"))


_IQR_SQL = """, q AS (SELECT {sel} FROM train),
b AS (UNPIVOT q ON COLUMNS(*) INTO NAME column_name VALUE qs),
bounds AS (SELECT column_name, qs[1] - 1.5 * (qs[2] - qs[1]) AS lo, qs[2] + 1.5 * (qs[2] - qs[1]) AS hi FROM b),
long AS (UNPIVOT (SELECT {cast} FROM train) ON COLUMNS(*) INTO NAME column_name VALUE v)
SELECT bounds.column_name, CAST(count(v) FILTER (WHERE v < lo OR v > hi) AS BIGINT) AS outlier_count
FROM bounds LEFT JOIN long ON long.column_name = bounds.column_name GROUP BY bounds.column_name"""
_IQR_SQL = _IQR_SQL.format(
    sel=", ".join(f"quantile_cont({c}, [0.25, 0.75]) AS {c}" for c in NUM),
    cast=", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUM))


@register("a05_iqr_outliers", sql_with(_IQR_SQL))
def a05_iqr_outliers(spark, d):
    return P.iqr_outlier_counts(bank_train(spark, d), ROLES)


_ALL = ["id", "age", "job", "marital", "education", "contact", "balance", "duration", "campaign", "previous", "y"]
_A16_SQL = (", " + _IQR_SQL[2:].split("\nSELECT")[0].replace("FROM train", "FROM dtrain") + ",\n"
            "oc AS (SELECT bounds.column_name, count(v) FILTER (WHERE v < lo OR v > hi) AS value "
            "FROM bounds LEFT JOIN long ON long.column_name = bounds.column_name GROUP BY bounds.column_name),\n"
            "mc AS (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS value FROM dtrain"
                                           for c in _ALL) + ")\n"
            "SELECT 'missing_values' AS \"check\", column_name, CAST(value AS DOUBLE) AS value FROM mc WHERE value > 0\n"
            "UNION ALL SELECT 'outliers', column_name, CAST(value AS DOUBLE) FROM oc\n"
            "UNION ALL SELECT 'total_missing', NULL, CAST(sum(value) AS DOUBLE) FROM mc\n"
            "UNION ALL SELECT 'row_count', NULL, CAST(count(*) AS DOUBLE) FROM dtrain\n"
            "UNION ALL SELECT 'duplicates', NULL, CAST(coalesce(sum(c - 1), 0) AS DOUBLE) FROM "
            "(SELECT count(*) AS c FROM dtrain GROUP BY ALL_COLS)\n"
            "UNION ALL SELECT 'target_distribution', CAST(y AS VARCHAR), CAST(count(*) AS DOUBLE) FROM dtrain GROUP BY y")
_A16_SQL = _A16_SQL.replace("ALL_COLS", ", ".join(_ALL))


@register("a16_validation", sql_with(_A16_SQL))
def a16_validation(spark, d):
    base = bank_materialized(spark, d)
    return P.validation_table(bank_train(spark, d, dirty=True, base=base), ROLES)
