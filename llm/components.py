"""Connected components of an edge list by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest of its neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are handed to the smallest of them. Edges run from large to small."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u")
    return (
        moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u != v")
        .union(least.select("u", F.col("m").alias("v")))
        .distinct()
    )


def _done(edges: DataFrame) -> bool:
    """True when every node hands over to one other, which hands over to none."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("x").agg(F.sum("out").alias("n_out"), F.max("into").alias("into")).where("n_out > 1 or n_out = into").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); the component is its smallest node.

    A node with very many neighbours costs no more than its edges: its minimum is
    an aggregate with partial steps. The rounds end when all edges lead to a smallest
    node, which takes about log n of them.
    """
    now = stored(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "edges"
    )
    while not _done(now):
        now = stored(_small_star(_large_star(now)), "edges")
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
