"""Candidate search inside cells: rows of one cell are compared in numpy blocks.

Rows are dealt by cell and sorted; a task walks the runs of equal cells and
returns links, never pairs: per node one row with the smallest node it was tied
to there and the weight of its links.  A run longer than ``limit`` is not
compared in that task.  Its rows are passed on in blocks of ``limit``, and every
two blocks of the cell meet in a task of their own, so the largest cell costs
many tasks and no task holds more than two blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import stored

LIMIT = 4096
CHUNK_ROWS = 1 << 17

Links = tuple[np.ndarray, np.ndarray, np.ndarray]  # node, tied to, weight
Cols = dict[str, np.ndarray]


def numpy_columns(t: pa.Table | pa.RecordBatch) -> Cols:
    """Columns as numpy; binary columns as they are in Arrow order, an object array."""
    out = {}
    for name in t.schema.names:
        col = t.column(name)
        out[name] = col.to_numpy() if isinstance(col, pa.ChunkedArray) else col.to_numpy(zero_copy_only=False)
    return out


def offset_pairs(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs inside the runs [starts, ends), in arrays: first every row with the next, then the second next."""
    length = ends - starts
    i = np.concatenate([np.empty(0, np.int64)]) if not len(starts) else np.repeat(starts, length) + (
        np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length))
    end = np.repeat(ends, length)
    k = 1
    while True:
        more = i + k < end
        i, end = i[more], end[more]
        if not len(i):
            return
        yield i, i + k
        k += 1


def compare_cells(rows: DataFrame, runs: Callable[[Cols, np.ndarray, np.ndarray], Links],
                  blocks: Callable[[Cols, Cols], Links], limit: int = LIMIT) -> DataFrame:
    """(a, b, w) links found in the cells of ``rows`` (cell bigint, then payload columns)."""
    payload = [f for f in rows.schema if f.name != "cell"]
    hot_fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in payload)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [f.name for f in payload]

    def batch(links: Links | None, hot: pa.Table | None, block: np.ndarray | None, schema: pa.Schema) -> pa.RecordBatch:
        n = len(links[0]) if links is not None else hot.num_rows
        got: dict[str, pa.Array] = {}
        if links is not None:
            got = {k: pa.array(v.astype(np.int64)) for k, v in zip(("a", "b", "w"), links)}
        else:
            got = {k: hot.column(k).combine_chunks() for k in ["cell", *names]}
            got["block"] = pa.array(block.astype(np.int64))
        return pa.RecordBatch.from_arrays(
            [got[f.name] if f.name in got else pa.nulls(n, f.type) for f in schema], schema=schema)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        schema = None
        hot_cell, hot_rows = None, 0

        def work(t: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, hot_cell, hot_rows
            cell = t.column("cell").to_numpy()
            cut = np.flatnonzero(cell[1:] != cell[:-1]) + 1
            starts = np.concatenate([[0], cut])
            ends = np.concatenate([cut, [len(cell)]])
            # the last run may go on, unless it is already known to be a hot one
            if not last and cell[starts[-1]] != hot_cell and ends[-1] - starts[-1] <= limit:
                keep = starts[-1]
                starts, ends = starts[:-1], ends[:-1]
            else:
                keep = len(cell)
            held = t.slice(keep) if keep < len(cell) else None
            if not len(starts):
                return
            hot = (ends - starts > limit) | (cell[starts] == (hot_cell if hot_cell is not None else np.nan))
            for s, e in zip(starts[hot], ends[hot]):
                if cell[s] != hot_cell:
                    hot_cell, hot_rows = cell[s], 0
                yield batch(None, t.slice(s, e - s), (hot_rows + np.arange(e - s)) // limit, schema)
                hot_rows += e - s
            plain = ~hot & (ends - starts > 1)
            if plain.any():
                links = runs(numpy_columns(t.select(["cell", *names])), starts[plain], ends[plain])
                if len(links[0]):
                    yield batch(links, None, None, schema)

        for b in batches:
            if schema is None:
                schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("w", pa.int64()), ("cell", pa.int64()),
                                    ("block", pa.int64()), *[b.schema.field(n) for n in names]])
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            if held.num_rows >= CHUNK_ROWS:
                yield from work(held.combine_chunks(), False)
        if held is not None and held.num_rows:
            yield from work(held.combine_chunks(), True)

    found = stored(rows.repartition(parts, "cell").sortWithinPartitions("cell")
                   .mapInArrow(walk, f"a bigint, b bigint, w bigint, cell bigint, block bigint, {hot_fields}"), "cells")
    links = found.where("block is null").select("a", "b", "w")
    hot = found.where("block is not null").select("cell", "block", *names)
    count = hot.groupBy("cell").agg((F.max("block") + 1).alias("blocks"))
    meet = (hot.join(count, "cell")
            .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
            .select("cell", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
                    (F.col("block") > F.col("other")).alias("right"), *names))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def close(t: pa.Table) -> pa.RecordBatch | None:
            right = t.column("right").to_numpy(zero_copy_only=False)
            cols = numpy_columns(t.select(["cell", *names]))
            if t.column("x")[0].as_py() == t.column("y")[0].as_py():
                links = runs(cols, np.array([0]), np.array([t.num_rows]))
            else:
                links = blocks({k: v[~right] for k, v in cols.items()}, {k: v[right] for k, v in cols.items()})
            return pa.RecordBatch.from_arrays([pa.array(v.astype(np.int64)) for v in links], names=["a", "b", "w"])

        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t]).combine_chunks()
            key = np.stack([held.column(c).to_numpy() for c in ("cell", "x", "y")])
            cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
            for s, e in zip(np.concatenate([[0], cut[:-1]]) if len(cut) else [], cut):
                yield close(held.slice(int(s), int(e - s)))
            held = held.slice(int(cut[-1])) if len(cut) else held
        if held is not None and held.num_rows:
            yield close(held)

    far = (meet.repartition(parts, "cell", "x", "y").sortWithinPartitions("cell", "x", "y")
           .mapInArrow(pairs, "a bigint, b bigint, w bigint"))
    return links.union(far)
