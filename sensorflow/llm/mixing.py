"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong
to).  On that aggregate a min-cost flow routes token capacity from patterns to
source quotas: the k-th copy of a pattern's tokens is an edge of cost 2k - 1, so
repetition is spread before anything is repeated more.  The flow leaves a token
count per pattern and copy; documents are then selected in the order of a seeded
hash up to those counts.  Where a document does not fit, the run goes on behind it
with documents of at most half of what is missing, which halves what is missing at
each further stop; when it meets no more stop, the one document that fits best is
taken too.  If all that fit are taken and words are missing still, the shortest
document left over is taken first and the run is done again behind it; what comes
nearest counts.  That is a few hash values and sizes per pattern and copy, so
selecting moves no document.

What reaches the driver is one row per membership pattern.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorflow.llm.common import stored, table, word_count

WEIGHTS = (3, 1, 2)
SHARE = (3, 2)  # 150 % of all sizes, as a fraction
MAX_COPIES = 2
SEED = 20240
# The hash order is cut into lanes: sums per lane find the lane of a cut, only that lane is sorted.
LANE_BITS = 12
ANY_SIZE = (1 << 63) - 1
TRIES = 3
Key = tuple[str, int]  # membership pattern and copy
RUN = "struct<after: bigint, until: bigint, most: bigint>"  # null: from the first, to the last


def by_code_point(names: list[str | None]) -> list[str | None]:
    return sorted((n for n in names if n is not None)) + [n for n in names if n is None]


def quotas(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS,
           share: tuple[int, int] = SHARE, most: int = MAX_COPIES) -> dict[str | None, float]:
    """Target of each source: its weight's part of the share, stopped at ``most`` times its size."""
    order = by_code_point(list(sizes))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = sum(sizes.values()) * share[0] / share[1]
    full: set = set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        per = sum(weight[s] for s in order if s not in full)
        target = {s: float(most * sizes[s]) if s in full else left * weight[s] / per for s in order}
        over = {s for s in order if s not in full and target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


def route(patterns: dict[str, int], quota: dict[str | None, int], copies: int) -> dict[tuple[str, int], dict]:
    """Min-cost flow from pattern copies to sources: tokens of (pattern, copy) counted for each source.

    Successive cheapest paths; nodes are patterns and sources, capacities integers.
    """
    start, end = ("start",), ("end",)
    cap: dict = {}
    cost: dict = {}
    out: dict = {}

    def edge(u, v, c, w, tag=None):
        for x, y, cc, ww in ((u, v, c, w), (v, u, 0, -w)):
            k = (x, y, tag, x == u)
            cap[k], cost[k] = cc, ww
            out.setdefault(x, []).append(k)

    for p, size in patterns.items():
        for k in range(1, copies + 1):
            edge(start, ("p", p), size, 2 * k - 1, k)
        for s in json.loads(p):
            edge(("p", p), ("s", s), size * copies, 0)
    for s, q in quota.items():
        edge(("s", s), end, q, 0)
    back = {k: (k[1], k[0], k[2], not k[3]) for k in cap}
    while True:
        dist, via, queue, inside = {start: 0}, {}, deque([start]), {start}
        while queue:
            u = queue.popleft()
            inside.discard(u)
            for k in out.get(u, ()):
                if cap[k] > 0 and dist[u] + cost[k] < dist.get(k[1], 1 << 60):
                    dist[k[1]], via[k[1]] = dist[u] + cost[k], k
                    if k[1] not in inside:
                        queue.append(k[1])
                        inside.add(k[1])
        if end not in dist:
            break
        path, v = [], end
        while v != start:
            path.append(via[v])
            v = via[v][0]
        push = min(cap[k] for k in path)
        for k in path:
            cap[k] -= push
            cap[back[k]] += push
    flow = {}
    for p in patterns:
        per_source = {s: cap[(("s", s), ("p", p), None, False)] for s in json.loads(p)}
        todo = deque((s, f) for s, f in per_source.items() if f)
        for k in range(1, copies + 1):
            room, got = cap[(("p", p), start, k, False)], {}
            while room and todo:
                s, f = todo.popleft()
                got[s] = min(f, room)
                room -= got[s]
                if f > got[s]:
                    todo.appendleft((s, f - got[s]))
            flow[p, k] = got
    return flow


def order_hash(seed: int = SEED) -> Column:
    """The seeded order of documents: rows that are equal in doc_id and text stay together."""
    return F.xxhash64(F.lit(seed), "doc_id", "text")


def pattern_of(sources: Column) -> Column:
    """The membership pattern as JSON: its distinct sources in order, null last."""
    none = F.array().cast("array<string>")
    return F.to_json(F.array_sort(F.array_distinct(F.coalesce(sources.cast("array<string>"), none))))


def fit(docs: DataFrame, sources: Column, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE,
        copies: int = MAX_COPIES, seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, cuts, targets): sizes and hashes of all documents, the cuts per pattern, the targets per source."""
    spark = docs.sparkSession
    rows = stored(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                              word_count(F.col("text").cast("binary")).alias("size"),
                              pattern_of(sources).alias("pattern"), order_hash(seed).alias("h")), "sizes")
    patterns = {r["pattern"]: int(r["total"])
                for r in rows.groupBy("pattern").agg(F.sum("size").alias("total")).collect()}
    sizes: dict[str | None, int] = {}
    for p, n in patterns.items():
        for s in json.loads(p):
            sizes[s] = sizes.get(s, 0) + n
    target = quotas(sizes, weights, share, copies) if sizes else {}
    flow = route(patterns, {s: round(t) for s, t in target.items()}, copies)
    targets = spark.createDataFrame([(s, sizes[s], float(t)) for s, t in target.items()],
                                    "source string, source_size bigint, target double")
    # one row per membership pattern and copy from here on, as the driver has held already
    return rows, stored(_cuts(rows, {k: (sum(got.values()), patterns[k[0]]) for k, got in flow.items()}), "cuts"), targets


def _in_runs(runs: Column) -> Column:
    """Whether a row (h, size) lies in one of the runs."""
    h, size = F.col("h"), F.col("size")
    return F.exists(runs, lambda r: (size <= r["most"]) & F.coalesce(h > r["after"], F.lit(True))
                    & F.coalesce(h < r["until"], F.lit(True)))


def _taken(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Adds ``copies`` to rows that have pattern, h and size: one for each cut that takes them."""
    n = F.aggregate("cuts", F.lit(0), lambda n, c: n + F.when(_in_runs(c["runs"]) | F.array_contains(c["extra"], F.col("h")), 1).otherwise(0))
    return rows.join(F.broadcast(cuts), "pattern").withColumn("copies", n).drop("cuts")


def mix(docs: DataFrame, sources: Column, **how) -> tuple[DataFrame, DataFrame]:
    """(plan, targets).

    plan: one row per row of ``docs``: doc_id, size, pattern (JSON of its sorted
    sources), copies, taken = copies * size.  targets: source, source_size, target.
    ``sources`` is an array column over the columns of ``docs``; a null element is
    a source of its own, an empty or null array counts for no source and gives
    only texts without words.  Null texts have size 0.  Ties of the hash order
    (fully equal rows) are taken or left together.  An empty table gives two
    empty tables.
    """
    rows, cuts, targets = fit(docs, sources, **how)
    return _taken(rows, cuts).select("doc_id", "size", "pattern", "copies",
                                     (F.col("copies") * F.col("size")).alias("taken")), targets


def mixed(docs: DataFrame, sources: Column, **how) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it is taken; columns as they are."""
    _, cuts, _ = fit(docs, sources, **how)
    rows = docs.select(F.struct("*").alias("row"), pattern_of(sources).alias("pattern"),
                       word_count(F.col("text").cast("binary")).alias("size"), order_hash(how.get("seed", SEED)).alias("h"))
    return (_taken(rows, cuts).where("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*"))


def _cuts(rows: DataFrame, tokens: dict[Key, tuple[int, int]]) -> DataFrame:
    """(pattern, cuts): for each copy the runs of the hash order that are taken, and the hashes of documents besides.

    ``tokens``: of each (pattern, copy) how many to take and how many there are.
    """
    # a copy beyond the first that is not taken at all has no cut; one taken whole has one run
    cuts = {k: (0, [(None, None, ANY_SIZE)], []) for k, (n, there) in tokens.items() if n >= there and (n or k[1] == 1)}
    goals = {k: n for k, (n, _) in tokens.items() if k not in cuts and (n or k[1] == 1)}
    first: dict[Key, tuple[int, int]] = {}  # the document taken before the run: its hash and size
    for _ in range(TRIES):
        shortest = {}
        for k, off, runs, extra, left in _fill(rows, goals, first):
            if k not in cuts or off < cuts[k][0]:
                cuts[k] = (off, runs, extra)
            if left and left[1] <= tokens[k][0]:
                shortest[k] = left
        first = {k: left for k, left in shortest.items() if cuts[k][0] and left != first.get(k)}
        goals = {k: tokens[k][0] - size for k, (_, size) in first.items()}
        if not goals:
            break
    return (rows.sparkSession.createDataFrame([(p, runs, extra) for (p, _), (_, runs, extra) in cuts.items()],
                                              f"pattern string, runs array<{RUN}>, extra array<bigint>")
            .groupBy("pattern").agg(F.collect_list(F.struct("runs", "extra")).alias("cuts")))


def _fill(rows: DataFrame, goals: dict[Key, int], first: dict[Key, tuple[int, int]]) -> Iterator[tuple]:
    """(key, words off, runs, hashes besides, (hash, size) of the shortest document left) after the first run and after all.

    ``goals``: how many tokens to take besides the documents ``first``.
    """
    if not goals:
        return
    spark = rows.sparkSession
    runs: dict[Key, list] = {k: [] for k in goals}
    missing = dict(goals)
    at = {k: (None, ANY_SIZE) for k in goals}
    ends = []
    besides = {k: first[k][0] if k in first else None for k in goals}
    while at:
        got = _next_stop(rows, spark.createDataFrame([(*k, besides[k], *at[k], missing[k]) for k in at],
                                                     "pattern string, copy int, besides bigint, after bigint, most bigint, missing bigint"))
        for k, (after, most) in list(at.items()):
            until, missing[k] = got.get(k, (None, missing[k]))
            runs[k] = [*runs[k], (after, until, most)]
            at[k] = (until, missing[k] // 2)
            if until is None or missing[k] < 2:  # no stop was met, or nothing is left to halve
                del at[k]
            if len(runs[k]) == 1 or k not in at:
                ends.append((*k, besides[k], len(runs[k]), runs[k], missing[k]))
    states = spark.createDataFrame(ends, f"pattern string, copy int, besides bigint, stops int, runs array<{RUN}>, missing bigint")
    off = F.abs(F.col("missing") - F.col("size"))
    best = (rows.join(F.broadcast(states), "pattern")
            .where((F.col("missing") > 0) & (F.col("size") > 0) & ~_in_runs(F.col("runs")) & ~F.col("h").eqNullSafe(F.col("besides")))
            .groupBy("pattern", "copy", "stops")
            .agg(F.min(F.when(off < F.col("missing"), F.struct(off.alias("off"), "h"))).alias("best"),
                 F.min(F.struct("size", "h")).alias("shortest")))
    found = {(r.pattern, r.copy, r.stops): r for r in best.collect()}
    for p, c, b, stops, taken, lacks in ends:
        r = found.get((p, c, stops))
        extra = [h for h in (b, r.best.h if r and r.best else None) if h is not None]
        last = stops == len(runs[p, c])
        yield (p, c), r.best.off if r and r.best else lacks, taken, extra, (r.shortest.h, r.shortest.size) if r and last else None


def _next_stop(rows: DataFrame, at: DataFrame) -> dict[Key, tuple[int | None, int]]:
    """Of each (pattern, copy): the hash of the first document that does not fit, and what is missing there.

    Of documents past ``after`` in the hash order, those of size ``most`` or less,
    but not ``besides``, are taken while they fit into ``missing``.  Without such a
    stop the hash is null.
    """
    lanes = F.shiftright("h", 64 - LANE_BITS).cast("int")
    cum = Window.partitionBy("pattern", "copy").orderBy("lane").rowsBetween(Window.unboundedPreceding, 0)
    open_ = (rows.join(F.broadcast(at), "pattern")
             .where((F.col("size") <= F.col("most")) & F.coalesce(F.col("h") > F.col("after"), F.lit(True))
                    & ~F.col("h").eqNullSafe(F.col("besides")))
             .withColumn("lane", lanes))
    sums = (open_.groupBy("pattern", "copy", "missing", "lane").agg(F.sum("size").alias("size"))
            .withColumn("until", F.sum("size").over(cum)))
    # the first lane that cannot be taken whole, and the tokens still to take there
    over = F.col("until") > F.col("missing")
    crossing = stored(sums.groupBy("pattern", "copy", "missing")
                      .agg(F.min(F.when(over, F.col("lane"))).alias("lane"), F.max("until").alias("total"),
                           F.min(F.when(over, F.col("until") - F.col("size"))).alias("before")), "crossing")
    out = {}
    stops = []
    for r in crossing.collect():
        out[r.pattern, r.copy] = (None, r.missing - r.total)
        if r.lane is not None:
            stops.append((r.pattern, r.copy, r.lane, r.missing - r.before))
    if not stops:
        return out
    stops = at.sparkSession.createDataFrame(stops, "pattern string, copy int, lane int, rest bigint")
    # equal hashes, which are equal documents, fit together or not at all
    run = Window.partitionBy("pattern", "copy").orderBy("h").rangeBetween(Window.unboundedPreceding, 0)
    inside = (open_.join(F.broadcast(stops), ["pattern", "copy", "lane"]).withColumn("sum", F.sum("size").over(run))
              .groupBy("pattern", "copy", "rest")
              .agg(F.min(F.when(F.col("sum") > F.col("rest"), F.col("h"))).alias("until"),
                   F.max(F.when(F.col("sum") <= F.col("rest"), F.col("sum"))).alias("sum")))
    for r in inside.collect():
        out[r.pattern, r.copy] = (r.until, r.rest - (r.sum or 0))
    return out


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: every source near its target, no document more than twice."""
    plan, targets = mix(table(spark, sf_dir, "documents"), F.array("source"))
    targets = targets.withColumn("pattern", pattern_of(F.array("source")))
    return (plan.join(F.broadcast(targets), "pattern")  # one row per source
            .select("doc_id", "size", "source_size", "target", "taken", "copies", "source"))
