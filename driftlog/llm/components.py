"""Connected components of an edge table, by alternating star steps.

A large star moves every larger neighbour of a node to the node's smallest
neighbour, a small star the smaller ones; both keep the components, and
repeated they leave one star per component (Kiveris and others, 2014). Each
step is a grouped minimum and a join, so a node with very many neighbours is
combined before the shuffle and its join side may be split; the edges are
written to the shared folder after every round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.llm.scratch import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger to the smaller node."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (columns a, b); the root is the component's smallest node."""
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    pairs = written(pairs, "edges")
    before = None
    while True:
        pairs = written(_small_star(_large_star(pairs)), "stars")
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")) \
        .unionAll(pairs.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
