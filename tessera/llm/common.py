"""What the operators share: tables written in the shared folder, columns
under names that cannot clash, and connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.session import checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` in the shared folder and read it back: lineage ends here
    and a lost executor reads files again."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lowered(column):
    """A-Z to a-z, nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def range_cuts(df: DataFrame, column: str, parts: int) -> list[int]:
    """At most parts - 1 values that cut a long column into about equal ranges."""
    shares = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(column, shares, 20 * parts)).first()[0] if shares else None
    return sorted(set(found or ()))


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of (a, b) links by alternating large-star and
    small-star steps: (node, component) with the smallest node as component.

    Each step is a minimum per node and one equi-join; a node's neighbours
    are never collected. The number of rounds is logarithmic in the size of
    the largest component."""
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .filter("u <> v").distinct(), name)
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        edges = written(small, name)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _stars(edges: DataFrame) -> bool:
    """Whether each node has one edge and no edge leads to a node with one."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 OR up > 0 AND down > 0").isEmpty()
