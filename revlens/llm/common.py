"""Shared helpers of the training-data operators: table reads, hash splits, scratch tables, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.session import scratch_path

END_ID = 2


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc(col: str = "doc_id") -> Column:
    """crc32 of an id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def text_key(col: str = "text") -> Column:
    """With the id the key of a row: a hash of the text; a null text counts as empty."""
    return F.xxhash64(F.coalesce(F.col(col), F.lit("")))


def materialize(spark: SparkSession, df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs the tasks it ran, never the steps
    before the table, and every later reader sees the same rows.
    """
    path = scratch_path(spark, "llm", tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def connected_components(spark: SparkSession, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node on an edge; root is the smallest node reachable.

    Alternating large-star / small-star contraction.  Each half is a partial
    aggregate (the smallest neighbour of a node) and an equi-join with it, so
    no task ever holds the neighbours of a hub.  Each round is written to the
    checkpoint folder; rounds grow with the logarithm of the graph's size.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = materialize(spark, e, "cc")
    mark = _mark(e)
    while mark[0]:
        sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (sym.join(low, "u").where("v > u")
                 .select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        kept = (large.join(low, "u").where("v <> m")
                .select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")))
        e = materialize(spark, kept.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc")
        now = _mark(e)
        if now == mark:
            break
        mark = now
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(e: DataFrame) -> tuple:
    """Edge count and an order-free checksum: equal marks mean an unchanged edge set."""
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
