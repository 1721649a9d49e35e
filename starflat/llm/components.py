"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflat.llm.common import staged


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every linked node; the root is the component's smallest node.

    Rounds of two steps until nothing changes: each node hangs its larger
    neighbours below its smallest one, then its smaller ones. Both keep the
    components and turn each into a star, in about log(n) rounds. Neighbour
    lists are never gathered: the smallest neighbour is an aggregate, joined
    back, and AQE splits the join of a node with very many links. Each round is
    written to the shared folder. Self links and NULL nodes are ignored.
    """
    edges = (
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter("u > v")
        .distinct()
    )
    edges = staged(edges, "links")
    before = _state(edges)
    while before[0]:
        edges = staged(_small_star(_large_star(edges)), "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    children = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return children.unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of u go below the smallest of u and all its neighbours."""
    # A node's smallest neighbour is smaller than itself in rows (u, v) only.
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    up = edges.select(F.col("v").alias("node"), F.col("u").alias("larger"))
    hung = up.join(least.withColumnRenamed("u", "node"), "node", "left").select(
        F.col("larger").alias("u"), F.coalesce("m", "node").alias("v")
    )
    return hung.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours go below the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    smaller = (
        edges.join(least, "u")
        .filter("v > m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return smaller.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
    ).first()
    return row["n"], row["s"]
