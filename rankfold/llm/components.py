"""Connected components of links, by alternating stars over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.llm.common import spread_join, written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head())


def _with_least(edges: DataFrame, total: int) -> DataFrame:
    """``u, v, m``: links with the least neighbour of ``u``; a node with very many stays spread."""
    least = written(edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n_met")), "least")
    return spread_join(edges, least, ["u"], total)


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    pulled = _with_least(both, 2 * total).where("v > u")
    return pulled.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    pulled = _with_least(edges, total)
    made = pulled.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(pulled.select("u", F.col("m").alias("v")))
    return made.where("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every linked node but the roots; ``links``: two columns of longs.

    The root is the smallest node that can be reached. Each round writes its links, all to
    smaller nodes, and the rounds end when none changes: after about the logarithm of the
    longest chain, squared. Links of a node with a thousandth of all are not gathered.
    """
    first, second = links.columns
    a, b = F.col(first), F.col(second)
    edges = links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = written(edges, "links")
    before, now = None, _state(edges)
    while now != before and now[0]:
        large = written(_large_star(edges, now[0]), "links")
        edges = written(_small_star(large, now[0]), "links")
        before, now = now, _state(edges)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
