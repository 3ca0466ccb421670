"""Embedding near-dedup with randomised-rotation binary codes.

A unit vector is turned by a seeded random rotation; its code keeps one sign bit
per coordinate and its correction factor the inner product of the turned vector
with its own code.  <code of o, turned q> / factor of o is an unbiased estimate
of <o, q> with a known spread, so a confidence bound tells which pairs can reach
the threshold; only those are computed again exactly, in double precision.

Pairs are sought in cells of several tables.  A table has two more rotations, which
name a vector by its nearest signed axes: the ``PROBES`` nearest of each rotation,
all combinations, are its cells.  How likely vectors at the threshold share no cell
of a table depends on their length alone, and tables are independent, so their
number follows from the length: about one such pair in 100,000 meets in none.  A
pair that shares several cells is counted in the first.  Equal vectors are one
node.  Cells longer than the limit are compared block by block in many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.llm.cells import LIMIT, Cols, Links, compare_cells
from sensorflow.llm.common import stored, table
from sensorflow.llm.graph import components, local_roots

THRESHOLD = 0.95
PROBES = 3
# Pairs at cosine 0.95 that share no cell of one table, by length (simulated, rounded up), and how many may meet in no table.
APART = {64: 0.03, 128: 0.05, 256: 0.07, 512: 0.10, 1024: 0.14, 2048: 0.18}
APART_MOST, LOST = 0.25, 1e-5
SEED = 11
SIGMAS = 3.5  # width of the confidence bound
EXACT_ROWS = 1 << 15


def rotation(d: int, which: int) -> np.ndarray:
    """A random orthogonal matrix that depends on nothing but its size and number."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, which, d]).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Turned vectors, their sign bits (packed) and correction factors."""
    turned = unit @ rotation(unit.shape[1], 0).T
    return turned, np.packbits(turned >= 0, axis=1), np.abs(turned).sum(1) / np.sqrt(unit.shape[1])


def nearest_axes(unit: np.ndarray, which: int) -> np.ndarray:
    """For each vector the PROBES nearest of the 2d signed axes of a rotation, ascending."""
    turned = unit @ rotation(unit.shape[1], which).T
    both = np.concatenate([turned, -turned], 1)
    k = min(PROBES, both.shape[1])
    return np.sort(np.argpartition(-both, k - 1, axis=1)[:, :k], axis=1)


def tables(d: int) -> int:
    """How many tables vectors of a length need."""
    apart = next((x for most, x in APART.items() if d <= most), APART_MOST)
    return math.ceil(math.log(LOST) / math.log(apart))


def _unit(vec: np.ndarray, d: int) -> np.ndarray:
    v = np.frombuffer(b"".join(vec), np.float32).reshape(len(vec), d).astype(np.float64)
    v /= np.abs(v).max(1, keepdims=True)  # norms of very large or small vectors stay finite
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, node, n, d, vec, code, factor, axes) for each cell of each distinct vector."""
    for whole in batches:
        for at in range(0, whole.num_rows, 2048):
            b = whole.slice(at, 2048)
            lists = b.column(2)
            length = np.asarray(lists.value_lengths())
            for d in np.unique(length):
                take = np.flatnonzero(length == d)
                vec = np.stack([np.asarray(lists[int(i)].values, np.float32) for i in take])
                raw = np.array([v.tobytes() for v in vec], object)
                unit = _unit(raw, int(d))
                _, code, factor = codes(unit)
                axes = np.stack([nearest_axes(unit, which) for which in range(1, 2 * tables(int(d)) + 1)], 1).astype(np.uint16)
                code_b = np.array([c.tobytes() for c in code], object)
                axes_b = np.array([a.tobytes() for a in axes], object)
                k = axes.shape[2]
                rows = np.repeat(np.arange(len(take)), k * k)
                for t in range(axes.shape[1] // 2):
                    x, y = axes[:, 2 * t].astype(np.int64), axes[:, 2 * t + 1].astype(np.int64)
                    cell = (np.int64(t) << 57) | (np.int64(d) << 40) | (np.repeat(x, k, axis=1).ravel() << 20) | np.tile(y, (1, k)).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell), b.column(0).take(pa.array(take[rows])), b.column(1).take(pa.array(take[rows])),
                         pa.array(np.full(len(rows), d, np.int64)), pa.array(raw[rows], pa.binary()),
                         pa.array(code_b[rows], pa.binary()), pa.array(factor[rows]), pa.array(axes_b[rows], pa.binary())],
                        names=["cell", "node", "n", "d", "vec", "code", "factor", "axes"])


def _candidates(code: np.ndarray, factor: np.ndarray, turned: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs (code row, turned row) can reach the threshold: estimate plus bound."""
    d = turned.shape[1]
    sign = (np.unpackbits(code, axis=1, count=d).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(d))
    estimate = sign @ turned.T.astype(np.float32) / factor[:, None]
    spread = np.sqrt(np.maximum(1 - factor ** 2, 0)) / factor / np.sqrt(max(d - 1, 1))
    return estimate + (SIGMAS * spread)[:, None] + 1e-5 >= threshold


def _exact(unit: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    out = np.empty(len(i), bool)
    for s in range(0, len(i), EXACT_ROWS):
        e = slice(s, s + EXACT_ROWS)
        out[e] = np.einsum("ij,ij->i", unit[i[e]], unit[j[e]]) >= threshold
    return out


def near_links(nodes: DataFrame, threshold: float = THRESHOLD, limit: int = LIMIT) -> DataFrame:
    """(a, b, w) of nodes (node, n, embedding): a is tied to b and has w rows among its links found there."""

    def match(cols: Cols, groups: Iterator[tuple[np.ndarray, np.ndarray]]) -> Links:
        """``groups``: positions of rows to compare, the left with the right; the same array for pairs within."""
        node, n = cols["node"], cols["n"]
        weight = np.zeros(len(node), np.int64)
        a, b = [], []
        for left, right in groups:
            d = int(cols["d"][left[0]])
            both = left if left is right else np.concatenate([left, right])
            unit = _unit(cols["vec"][both], d)
            turned = unit @ rotations.setdefault(d, rotation(d, 0)).T
            code = np.frombuffer(b"".join(cols["code"][both]), np.uint8).reshape(len(both), -1)
            factor = cols["factor"][both]
            nl = len(left)
            at = 0 if left is right else nl
            for s in range(0, nl, 1024):
                e = min(s + 1024, nl)
                i, j = np.nonzero(_candidates(code[s:e], factor[s:e], turned[at:], threshold))
                i, j = i + s, j + at
                if left is right:
                    i, j = i[i < j], j[i < j]
                ok = _exact(unit, i, j, threshold)
                i, j = i[ok], j[ok]
                if not len(i):
                    continue
                axes = np.frombuffer(b"".join(cols["axes"][both]), np.uint16).reshape(len(both), 2 * tables(d), -1)
                first = _first_common(axes, i, j) == (cols["cell"][left[0]] & ~np.int64(((1 << 17) - 1) << 40))
                p, q = both[i], both[j]
                np.add.at(weight, p[first], n[q[first]])
                np.add.at(weight, q[first], n[p[first]])
                root = local_roots(len(both), i, j)
                own = np.flatnonzero(root != np.arange(len(both)))
                a.append(both[own])
                b.append(both[root[own]])
        counted = np.flatnonzero(weight)
        a, b = (np.concatenate([*x, counted]) for x in (a, b))
        w = np.concatenate([np.zeros(len(a) - len(counted), np.int64), weight[counted]])
        return node[a], node[b], w

    rotations: dict[int, np.ndarray] = {}

    def runs(cols: Cols, starts: np.ndarray, ends: np.ndarray) -> Links:
        return match(cols, ((r, r) for r in map(np.arange, starts, ends)))

    def blocks(left: Cols, right: Cols) -> Links:
        cols = {k: np.concatenate([left[k], right[k]]) for k in left}
        n = len(left["node"])
        return match(cols, iter([(np.arange(n), np.arange(n, len(cols["node"])))]))

    spots = nodes.select("node", "n", "embedding").mapInArrow(
        _spots, "cell bigint, node bigint, n bigint, d bigint, vec binary, code binary, factor double, axes binary")
    return compare_cells(spots, runs, blocks, limit)


def _first_common(axes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The first cell (table << 57 | x << 20 | y) that two vectors share."""
    out = np.full(len(i), -1, np.int64)
    todo = np.arange(len(i))
    for t in range(axes.shape[1] // 2):
        cell, shared = np.full(len(todo), t, np.int64) << 17, np.ones(len(todo), bool)
        for part in (2 * t, 2 * t + 1):
            x, y = axes[i[todo], part].astype(np.int64), axes[j[todo], part].astype(np.int64)
            common = np.where((x[:, :, None] == y[:, None, :]).any(2), x, 1 << 19).min(1)
            shared &= common < 1 << 19
            cell = (cell << 20) | common
        out[todo[shared]] = cell[shared]
        todo = todo[~shared]
        if not len(todo):
            break
    return out


def near_dedup(vectors: DataFrame, threshold: float = THRESHOLD, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components link
    with nothing; vectors of different length do not link.  Repeated vectors link
    with each other.  An empty table gives no rows; other columns are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists("embedding", lambda x: x != 0) & F.col("vec_id").isNotNull(), F.lit(False))
    nodes = stored(rows.where(usable).groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("n")), "vectors")
    links = stored(near_links(nodes, threshold, limit), "links")
    tied = components(links.where("a != b"))
    counted = links.where("w > 0").groupBy(F.col("a").alias("node")).agg(F.sum("w").alias("w"))
    labels = stored(nodes.join(counted, "node", "left").join(tied, "node", "left")
                    .select("embedding", (F.coalesce("w", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                            F.coalesce("root", "node").alias("component_id")), "labels")
    linked = rows.where(usable).join(labels, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate links and components of all embeddings."""
    return near_dedup(table(spark, sf_dir, "embeddings"))
