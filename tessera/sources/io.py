"""Sources and sinks: S01-S04, S06-S12.

CSV and Parquet through Spark's own readers/writers; parameters, kept-column
logs and fitted models are written as ordinary tables or ML model folders.
"""

from __future__ import annotations

import os

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.exprs import finite_table

# Text that pandas' CSV reader treats as missing by default.
CSV_NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                   "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                   "n/a", "nan", "null")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             null_tokens: tuple[str, ...] = CSV_NULL_TOKENS) -> DataFrame:
    """Header row, typed columns, missing values as NULL.

    Spark's reader knows one ``nullValue``, so all columns are read as text,
    the missing tokens become NULL in every column, and the columns are then
    cast to ``schema``; text that is no such value fails the query. Without
    a schema one scan infers it: int or long if all values are whole numbers,
    double if all are numbers, else text. NaN and infinities are NULL.
    """
    raw = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    toks = [t for t in null_tokens if t != ""]
    raw = raw.select(*[F.when(~F.col(c).isin(*toks), F.col(c)).alias(c) for c in raw.columns])
    if schema is None:
        kinds = raw.agg(*[F.struct(
            F.coalesce(F.bool_and(F.expr(f"try_cast(`{c}` AS INT) IS NOT NULL OR `{c}` IS NULL")), F.lit(False)).alias("small"),
            F.coalesce(F.bool_and(F.expr(f"try_cast(`{c}` AS BIGINT) IS NOT NULL OR `{c}` IS NULL")), F.lit(False)).alias("whole"),
            F.coalesce(F.bool_and(F.expr(f"try_cast(`{c}` AS DOUBLE) IS NOT NULL OR `{c}` IS NULL")), F.lit(False)).alias("number"),
            F.count(c).alias("n")).alias(f"c{i}") for i, c in enumerate(raw.columns)]).first()
        types = {}
        for i, c in enumerate(raw.columns):
            k = kinds[f"c{i}"]
            types[c] = "string" if not k["n"] else "int" if k["small"] else "bigint" if k["whole"] else "double" if k["number"] else "string"
    else:
        fields = (T._parse_datatype_string(schema) if isinstance(schema, str) else schema).fields
        types = {f.name: f.dataType for f in fields}
        missing = set(types) - set(raw.columns)
        if missing:
            raise ValueError(f"{path} has no column(s) {sorted(missing)}")
        raw = raw.select(*types)
    return finite_table(raw.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()]))


def read_table(spark: SparkSession, path: str, **kw) -> DataFrame:
    """Parquet or CSV by suffix."""
    p = path.rstrip("/").lower()
    if p.endswith(".csv"):
        return read_csv(spark, path, **kw)
    return finite_table(spark.read.parquet(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header, no index (Spark rows have none)."""
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: tuple[str, ...] = ()) -> None:
    """S04; pass ``partition_by=('split',)`` so split scans prune files."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def split_scan(df: DataFrame, which: str, split_col: str = "split") -> DataFrame:
    """Rows of one split, flag dropped. On a table written with
    ``partitionBy('split')`` this prunes to one folder."""
    if split_col not in df.columns:
        raise ValueError(f"combined table must have a '{split_col}' column")
    return df.where(F.col(split_col) == F.lit(which)).drop(split_col)


def scan_external_csvs(spark: SparkSession, folder: str, **kw) -> list[tuple[str, DataFrame]]:
    """One reader per CSV in the folder (their schemas differ)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path) or not fs.getFileStatus(path).isDirectory():
        return []
    found = {f.getPath().getName(): f.getPath().toString() for f in fs.listStatus(path)}
    return [(n, read_csv(spark, found[n], **kw)) for n in sorted(found) if n.lower().endswith(".csv")]


def _drop_versions(spark: SparkSession, folder: str, keep: int) -> None:
    """All but the newest folders go; their names sort by time."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = sorted((f.getPath().getName(), f.getPath()) for f in fs.listStatus(path))
    for _, old in found[:-keep]:
        fs.delete(old, True)


def refresh_warehouse(spark: SparkSession, train: DataFrame, test: DataFrame | None,
                      database: str = "bank", train_table: str = "train",
                      test_table: str = "test", location: str | None = None) -> list[str]:
    """Create the schema (optionally at a shared location) and replace
    the fact tables without a gap: all new tables are written to folders of their own first, then each table is
    pointed to its new folder, which changes the catalog alone. A reader, or a job that is lost
    before the swap, finds the old tables whole. The version before the present one stays for
    readers that still have it; older ones go. (Where the columns change, the table's
    entry is made anew, between two catalog calls.)"""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
    root = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    stamp = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    staged = {}
    for name, df in ((train_table, train), (test_table, test)):
        if df is not None:
            staged[name] = f"{root}/{name}.versions/{stamp}"
            df.write.parquet(staged[name])
    written = []
    for name, path in staged.items():
        full = f"{database}.{name}"
        if spark.catalog.tableExists(full) and spark.table(full).schema == spark.read.parquet(path).schema:
            spark.sql(f"ALTER TABLE {full} SET LOCATION '{path}'")
        else:
            spark.sql(f"DROP TABLE IF EXISTS {full}")
            spark.sql(f"CREATE TABLE {full} USING parquet LOCATION '{path}'")
        spark.catalog.refreshTable(full)
        _drop_versions(spark, f"{root}/{name}.versions", keep=2)
        written.append(full)
    return written


def export_reports(frames: dict[str, DataFrame], folder: str) -> list[str]:
    """Copy named tables (train/test and score reports) to one folder."""
    out = []
    for name, df in frames.items():
        p = os.path.join(folder, name)
        write_csv(df, p)
        out.append(p)
    return out


def save_params(params: DataFrame, path: str) -> None:
    """A fitted state table (operator, column, stat, value) as Parquet."""
    params.write.mode("overwrite").parquet(path)


def load_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(model, path: str) -> str:
    """An ML model or pipeline folder."""
    model.write().overwrite().save(path)
    return path


def load_model(model_class, path: str):
    """S11 read side: ``model_class`` is the fitted model's class (e.g.
    ``LogisticRegressionModel``)."""
    return model_class.load(path)


KEPT_SCHEMA = "fold INT, stage STRING, method STRING, param STRING, pos INT, column_name STRING"


def kept_columns_log(spark: SparkSession, fold: int, stage: str, method: str,
                     param: str | None, columns: list[str]) -> DataFrame:
    """One row per kept column, in order (a names list, so tiny)."""
    rows = [(fold, stage, method, param, i + 1, c) for i, c in enumerate(columns)]
    return spark.createDataFrame(rows, KEPT_SCHEMA)
