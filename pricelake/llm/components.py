"""Connected components of a link table by alternating large-star and small-star rounds.

Links are (u, v) with u != v.  Every round replaces links by links to the smallest neighbour, so
components end as stars around their smallest vertex; the number of rounds grows with the logarithm
of the number of vertices.  Minima are combined before the shuffle; each round is written to the
shared folder, which cuts the lineage and lets AQE split the join of a vertex with very many links.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _to_smallest(links: DataFrame, name: str) -> DataFrame:
    """(u, v) -> (v, m) for every v of u, m: the smallest of u and its v."""
    least = stored(links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), name)
    return links.join(least.withColumnRenamed("u", "_u"), F.col("u") == F.col("_u")).select("u", "v", "m")


def _print(links: DataFrame) -> tuple:
    """Number of links and an order-free sum over them: equal when nothing has changed."""
    r = links.agg(F.count("*").alias("n"),
                  F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).collect()[0]
    return r["n"], r["s"]


def components(links: DataFrame) -> DataFrame:
    """vertex, component_id (the smallest vertex reachable) of every vertex that has a link."""
    now = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .where("u <> v").distinct(), "links")
    seen = _print(now)
    while seen[0]:
        both = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(
            _to_smallest(both, "large-least").where("v > u and v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        small = _to_smallest(large, "small-least")
        small = (small.select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .unionAll(small.select(F.col("u").alias("a"), F.col("m").alias("b")))
                 .where("a <> b").distinct().select(F.col("a").alias("u"), F.col("b").alias("v")))
        now = stored(small, "small-star")
        after = _print(now)
        if after == seen:
            break
        seen = after
    rows = now.select(F.col("u").alias("vertex"), F.col("v").alias("component_id"))
    return rows.unionAll(rows.select(F.col("component_id").alias("vertex"), "component_id").distinct())


def spanning(n: int, i: np.ndarray, j: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """Smallest vertex of the class of each of n vertices under links i, j (and those of ``root``)."""
    root = np.arange(n) if root is None else root
    while len(i):           # hook roots onto the smaller one until all links agree
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        while (root[root] != root).any():
            root = root[root]
        more = root[i] != root[j]
        i, j = i[more], j[more]
    return root
