"""Connected components of links that do not fit one machine: alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import written


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root) for every node of a link; root is the smallest node of its component.

    Each round hangs all larger neighbours of a node on its smallest neighbour, then does the same among
    the smaller ones, until no link changes. Minima are aggregated before they are shuffled and joined
    back, so a node with very many links is never gathered. Self-links and repeats are allowed, nulls not.
    """
    a, b = F.col(left), F.col(right)
    edges = written(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "links"
    )
    state = _state(edges)
    while state[0]:
        edges = written(_small_star(_large_star(edges)), "links")
        state, before = _state(edges), state
        if state == before:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
