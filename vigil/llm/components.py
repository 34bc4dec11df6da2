"""Connected components of a distributed edge table, and spanning links inside a batch.

``connected_components`` alternates large-star and small-star rounds.  Every
round is grouped aggregation (partial minimum per node) and one equi-join whose
two sides are tables of the shared folder, so a hub node with very many links
is split by AQE; nothing is collected per node and nothing but two scalars per
round reaches the driver.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import staged

MAX_ROUNDS = 60


def spanning_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, root) that join the same nodes as the links (a, b); one per node at most.

    Vectorised hook-and-jump over the distinct nodes of one batch.
    """
    if not len(a):
        return a, b
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[:len(a)], inv[len(a):]
    root = np.arange(len(nodes))
    while True:
        rx, ry = root[x], root[y]
        open_ = rx != ry
        if not open_.any():
            break
        lo, hi = np.minimum(rx[open_], ry[open_]), np.maximum(rx[open_], ry[open_])
        np.minimum.at(root, hi, lo)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    linked = root != np.arange(len(nodes))
    return nodes[linked], nodes[root[linked]]


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v longs); component = least node reachable.

    Self links, repeated links and both directions are allowed; an empty edge
    table gives an empty result.
    """
    edges = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .where("u > v").distinct(), "cc-edges")
    mark = _mark(edges)
    for _ in range(MAX_ROUNDS):
        if not mark[0]:
            break
        n = 2 * mark[0]                  # both directions; a round never makes links
        # large star: every larger neighbour of u points to the least of u and its neighbours
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.min("v").alias("m")), "cc-least", n)
        up = (both.join(least, "u").where("v > u")
              .select(F.col("v").alias("u"), F.least("u", "m").alias("v")))
        edges = staged(up.distinct(), "cc-large", n)
        # small star: u and its smaller neighbours point to the least of them
        least = staged(edges.groupBy("u").agg(F.min("v").alias("m")), "cc-least", n)
        joined = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(joined.union(least.select("u", F.col("m").alias("v"))).distinct(), "cc-small", n)
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
