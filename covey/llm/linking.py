"""Connected components of links between numbers, in Spark rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..storage import scratch, stored

#: Rounds after which something must be wrong; the count needed grows with the logarithm of a component's size.
MAX_ROUNDS = 60


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of n points by links a - b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for each number in links the smallest that is reachable, itself included.

    Alternates two steps until nothing changes: each node's larger neighbours are hung on its smallest
    neighbour, then each node's smaller neighbours are. Each round is written to the shared folder, so a
    lost executor costs a part of one round. A node's neighbours are met by a join, never gathered; both
    sides of it come from storage, so that the rows of a node with very many links can be split.
    """
    small, large = F.least(a, b), F.greatest(a, b)
    with scratch(links.sparkSession):  # a round needs no more than the one before
        edges = _settled(stored(links.select(large.alias("u"), small.alias("v")).where("u <> v").distinct(), "links"))
    pairs = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return pairs.unionByName(pairs.select(F.col("component").alias("node"), "component").distinct())


def _settled(edges: DataFrame) -> DataFrame:
    """Each node's link to the smallest of its component, kept in storage."""
    for _ in range(MAX_ROUNDS):
        # Large star: both directions of each link; v's neighbours above v go to the least of v and its neighbours.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy(F.col("v").alias("w")).agg(F.min("u").alias("m")).select("w", F.least("w", "m").alias("m")), "least")
        large_star = both.where("u > v").join(least, F.col("v") == F.col("w")).select("u", F.col("m").alias("v")).where("u <> v").distinct()
        large_star = stored(large_star, "large-star")
        # Small star: v <= u for all links; u and its neighbours below it go to the least of these.
        least = stored(large_star.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")), "least")
        met = large_star.join(least, F.col("u") == F.col("w"))
        small_star = met.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct()
        new = stored(small_star, "small-star")
        changed = new.join(edges, ["u", "v"], "left_anti").limit(1).count() or edges.join(new, ["u", "v"], "left_anti").limit(1).count()
        edges = new
        if not changed:
            return stored(edges, "components", keep=True)
    raise RuntimeError("components did not settle")
