"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brokerhouse.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """`node` and `component` (its least node) for every node of the links (`a`, `b`); each round is a written table.

    Large star: every greater neighbour is linked with the least neighbour. Small star: every smaller neighbour is.
    Both only need a least value per node, combined before the shuffle and written before it meets the links, so a node
    with very many links is no burden.
    """
    edges = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    mark = _mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written before it is joined: the links of a node with very many can then be split
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large)
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        last, mark = mark, _mark(edges)
        if last == mark:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """The same for the same set of edges."""
    row = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.xxhash64("b", "a") % 1000003)).first()
    return tuple(row)
