"""Connected components of a link table, by alternating large-star and small-star rounds.

No round gathers the neighbours of a node: each takes a partial minimum per node
and joins it back, and the minima are written first so that the join is between
two fresh exchanges, which adaptive execution may split at a hub.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import drop_stored, stored


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of 0..n-1 over the links (a[i], b[i])."""
    lab = np.arange(n)
    while True:
        la, lb = lab[a], lab[b]
        if (la == lb).all():
            return lab
        np.minimum.at(lab, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            nxt = lab[lab]
            if (nxt == lab).all():
                break
            lab = nxt


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r.n, r.x


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link to another node; root: its smallest reachable node."""
    e = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
               .where("u != v").distinct(), "links")
    seen = _mark(e)
    while seen[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")), "low")
        # large star: neighbours above a node go to the smallest of node and neighbours
        large = stored(both.join(low, "u").where("v > u")
                       .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct(), "large")
        low2 = stored(large.groupBy("u").agg(F.min("v").alias("m")), "low2")
        # small star: a node and its neighbours below go to the smallest of them
        star = large.join(low2, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = stored(star.union(low2.select("u", F.col("m").alias("v"))).distinct(), "star")
        mark = _mark(nxt)
        for t in (e, low, large, low2):
            drop_stored(t)
        e = nxt
        if mark == seen:
            break
        seen = mark
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("node", F.col("node").alias("root")))
