"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.session import written


def stars(edges: DataFrame) -> DataFrame:
    """One round: every node's larger neighbours, then its smaller ones, are hung on its smallest neighbour.

    Takes and gives distinct edges (a, b) with a > b. Connections are kept; only rows and minima are shuffled, so a
    node with very many neighbours is split like any skewed key.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(smallest, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.filter(F.col("a") > F.col("b")).distinct()
    root = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(root, "a").filter(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.unionByName(root.select("a", F.col("m").alias("b"))).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge; the root is the smallest node of its component.

    ``edges`` has the columns a and b; directions, repeats and loops do not matter. Every round is written to the
    shared folder. The number of rounds grows with the logarithm of the longest path.
    """
    ends = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    state, before = written(ends, "edges"), None
    while True:
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before, state = now, written(stars(state), "stars")
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
