"""Connected components of an edge table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.store import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest
    neighbour (itself included)."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("n"), F.least("a", "m").alias("m"))
    return (both.join(least, both["a"] == least["n"]).filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the
    smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
    own = least.select(F.col("n").alias("a"), F.col("m").alias("b"))
    rest = (down.join(least, down["a"] == least["n"]).filter(F.col("b") != F.col("m"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return own.unionByName(rest).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a and b, of an
    orderable type): root is the smallest node of its component.

    Loops, repeated and reversed edges are fine; edges with a null end are
    left out; no edges give an empty result. Each round's edges are written
    to the shared folder. Edges only ever get closer to stars, so the number
    of rounds grows with the logarithm of the longest path, and a node of a
    huge component keeps one edge.
    """
    edges = written(edges.select("a", "b").dropna().filter("a <> b").distinct(), "edges")
    seen = None
    while True:
        edges = written(_small_star(_large_star(edges)), "edges")
        mark = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == seen:
            break
        seen = mark
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
