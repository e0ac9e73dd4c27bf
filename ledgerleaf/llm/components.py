"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.session import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from the larger to the smaller node."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of ``links(a, b)``; component is its smallest node.

    Every round is a written table, so lineage stays short and a lost executor
    costs one round.  Hubs are split by the skew handling of plain joins: the
    smallest neighbour is an aggregate, no neighbour list is ever gathered.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, "links")
    state = _state(edges)
    while state[0]:
        edges = written(_small_star(written(_large_star(edges).distinct(), "links")).distinct(), "links")
        before, state = state, _state(edges)
        if before == state:
            break
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
