"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priorframe.llm.common import written_once


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    inner = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return inner.unionAll(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; ``edges`` has bigint columns a, b; root is the least node.

    Each round is written to the shared folder, so lineage stays short. Both steps aggregate before they
    shuffle, and a node with very many edges is only a join key, which adaptive execution splits. NULL ends,
    loops and repeated edges are ignored. The number of rounds grows with the logarithm of the graph.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = written_once(now, "component-edges"), None
    while True:
        mark = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if mark == before or not mark[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                now.select(F.col("b").alias("node"), F.col("b").alias("root"))
            ).distinct()
        before = mark
        now = written_once(_small_star(_large_star(now).distinct()).distinct(), "component-edges")


def least_reached(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least position reachable by the links (i, j) from every position."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        root = root[root]
        if (root == before).all():
            break
    return root
