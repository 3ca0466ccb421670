"""Replay a table as a stream, in a given arrival order, through a real
Structured Streaming query, and read its sink back.

* The table is cut into micro-batches by ranges of the order column (Spark's range
  partitioner finds the cuts, nothing of them reaches the driver), of at most about
  ``ROWS_PER_BATCH`` rows each, and staged once, partitioned by batch.
  Rows without a place in the order are in the first batch.
* A staged batch is handed to the source by renaming its folder, not by a
  second copy.
* Default: one query runs continuously; after batch ``b`` is handed over
  the harness waits with ``processAllAvailable()``.  For
  event-time queries the query is then stopped and restarted once from its
  checkpoint with ``trigger(availableNow=True)`` to take the flush sentinel
  and run the final no-data batch.
* ``restart_each_batch=True``: the query is restarted from the checkpoint
  for every batch, so batch boundaries are exact and every run after the
  first is a recovery (used by the restart / exactly-once keys).
* Event-time queries need a final watermark to close their last windows: a
  sentinel row without key and far in the future ends the input.  Its own
  window never closes, so no row of it can reach an append sink and nothing
  has to be filtered out of the result.
* Sinks are idempotent: append mode uses the file sink (exactly-once via its
  commit log); update mode writes each micro-batch to its own
  ``batch=<id>`` folder with overwrite, so a replayed batch replaces itself.
* Sinks are read with the schema of what was written: a stream without rows
  gives an empty table.

All folders live under the shared checkpoint root (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sensorflow.operators.scan import BUCKET, BUCKET_ROWS
from sensorflow.session import path_exists, scratch_path
from sensorflow.sources.files import text_stream

FLUSH_TS = 4102444800          # 2100-01-01, far beyond any test row
ROWS_PER_BATCH = 5_000_000
TASKS_PER_BATCH = 12
BATCH = "__batch"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# a batch uploads its changes, not whole snapshots, and does not look a row up only to count it
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


@dataclass
class Run:
    root: str
    stage: str
    source: str
    checkpoint: str
    sink: str
    trigger: dict | None = None
    schema: T.StructType | None = None   # of the sink's rows

    def writer_trigger(self) -> dict:
        return self.trigger or {"availableNow": True}

    @classmethod
    def new(cls, spark: SparkSession, name: str) -> "Run":
        root = scratch_path(spark, f"stream-{name}")
        return cls(root, os.path.join(root, "stage"), os.path.join(root, "source"),
                   os.path.join(root, "checkpoint"), os.path.join(root, "sink"))


def stage(df: DataFrame, order_col: str, n_batches: int, path: str, text_col: str | None = None, ranges: bool = False) -> int:
    """Write ``df`` partitioned by micro-batch number (ranges of ``order_col``, equal places together).

    With ``ranges`` each row also gets the number of its range as the bucket of a running scan in this order;
    a batch's ranges of few rows share one number."""
    count = df.count()
    n_batches = max(n_batches, -(-count // ROWS_PER_BATCH))
    dealt = df.repartitionByRange(n_batches * TASKS_PER_BATCH, F.col(order_col).asc_nulls_first())
    dealt = dealt.withColumn(BATCH, F.floor(F.spark_partition_id() / TASKS_PER_BATCH).cast("int"))
    if ranges:
        shared = min(TASKS_PER_BATCH, -(-BUCKET_ROWS * n_batches * TASKS_PER_BATCH // max(count, 1)))
        inside = F.floor(F.spark_partition_id() % TASKS_PER_BATCH / shared)
        dealt = dealt.withColumn(BUCKET, (F.col(BATCH) * TASKS_PER_BATCH + inside).cast("int"))
    if text_col is None:
        dealt.write.mode("overwrite").partitionBy(BATCH).parquet(path)
    else:
        dealt.select(text_col, BATCH).write.mode("overwrite").partitionBy(BATCH).option("lineSep", "\n").text(path)
    return n_batches


def sentinel(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """One row of ``schema`` with far-future times and nothing else."""
    vals = {"ts": F.lit(FLUSH_TS), "arrival": F.lit(FLUSH_TS), "t": F.timestamp_seconds(F.lit(FLUSH_TS))}
    cols = [(vals.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*cols)


def _hand_over(spark: SparkSession, run: Run, b: int) -> None:
    """Move the staged folder of batch ``b`` below the source folder; a batch without rows has none."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    src = path(f"{run.stage}/{BATCH}={b}")
    fs = src.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(run.source))
    if fs.exists(src) and not fs.rename(src, path(f"{run.source}/batch{b}")):
        raise RuntimeError(f"could not hand over batch {b}")
    fs.mkdirs(path(f"{run.source}/batch{b}"))


def _await(q: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for the end of a bounded run; without ``timeout_s`` for as long as it takes."""
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"streaming query {q.name} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def replay(spark: SparkSession, name: str, data: DataFrame, order_col: str, n_batches: int,
           start: Callable[[DataFrame, Run], StreamingQuery], fmt: str = "parquet",
           text_col: str | None = None, flush: bool = True,
           on_batch: Callable[[int, Run], None] | None = None,
           restart_each_batch: bool = False, timeout_s: float | None = None, ranges: bool = False) -> Run:
    """Stage ``data`` and drive the query built by ``start(source_df, run)``
    through it (see module doc), then flush.  With ``ranges`` the stream's
    rows come with the bucket of a running scan (see :func:`stage`).  The session's settings are used
    as they are, but for the state store, which is set back afterwards."""
    before = {key: spark.conf.get(key, None) for key in STATE_STORE}
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    try:
        return _replay(spark, name, data, order_col, n_batches, start, fmt, text_col, flush, on_batch,
                       restart_each_batch, timeout_s, ranges)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def _replay(spark, name, data, order_col, n_batches, start, fmt, text_col, flush, on_batch,
            restart_each_batch, timeout_s, ranges) -> Run:
    run = Run.new(spark, name)
    schema = T.StructType([*data.schema.fields, *([T.StructField(BUCKET, T.IntegerType())] if ranges else [])])
    n = stage(data, order_col, n_batches, run.stage, text_col if fmt == "text" else None, ranges)

    def source() -> DataFrame:
        if fmt == "text":
            return text_stream(spark, f"{run.source}/*")
        return spark.readStream.schema(schema).parquet(f"{run.source}/*")

    if restart_each_batch:
        for b in range(n):
            _hand_over(spark, run, b)
            _await(start(source(), run), timeout_s)
            if on_batch:
                on_batch(b, run)
    else:
        run.trigger = {"processingTime": "0 seconds"}
        q = None
        try:
            for b in range(n):
                _hand_over(spark, run, b)
                if q is None:
                    q = start(source(), run)
                q.processAllAvailable()
                if on_batch:
                    on_batch(b, run)
        finally:
            if q is not None:
                q.stop()
        if q is not None and q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        run.trigger = None
    if flush:
        s = sentinel(spark, schema)
        end = f"{run.source}/flush"
        if fmt == "text":
            raise ValueError("a stream of text has no event time to flush")
        s.write.parquet(end)
        # final run from the checkpoint: the sentinel plus the no-data batch that
        # lets the last windows close
        _await(start(source(), run), timeout_s)
    return run


# ---- sinks -------------------------------------------------------------------

def append_sink(df: DataFrame, run: Run, name: str) -> StreamingQuery:
    run.schema = df.schema
    w = (df.writeStream.format("parquet").outputMode("append").queryName(name)
         .option("path", run.sink).option("checkpointLocation", run.checkpoint))
    return w.trigger(**run.writer_trigger()).start()


def batch_folder(run: Run, bid: int) -> str:
    return os.path.join(run.sink, f"batch={bid}")


def batch_folder_sink(df: DataFrame, run: Run, name: str, mode: str = "update") -> StreamingQuery:
    """Update/complete output: every micro-batch lands in ``sink/batch=<id>``
    (overwrite -> a replayed batch replaces its own output)."""
    run.schema = df.schema

    def write(bdf: DataFrame, bid: int) -> None:
        bdf.write.mode("overwrite").parquet(batch_folder(run, bid))
    return foreach_batch(df, run, name, write, mode)


def foreach_batch(df: DataFrame, run: Run, name: str, write: Callable[[DataFrame, int], None],
                  mode: str = "append") -> StreamingQuery:
    return (df.writeStream.outputMode(mode).queryName(name).foreachBatch(write)
            .option("checkpointLocation", run.checkpoint).trigger(**run.writer_trigger()).start())


def read_append(spark: SparkSession, run: Run) -> DataFrame:
    """The rows of the sink; none if nothing was written."""
    if not path_exists(spark, run.sink):
        return spark.createDataFrame([], run.schema)
    return spark.read.schema(run.schema).parquet(run.sink)


def read_batches(spark: SparkSession, run: Run) -> DataFrame:
    """The rows of the ``batch=<id>`` folders, with the column ``batch``."""
    schema = T.StructType([*run.schema.fields, T.StructField("batch", T.LongType())])
    if not path_exists(spark, run.sink):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(run.sink)


def read_latest(spark: SparkSession, run: Run, keys: list[str]) -> DataFrame:
    """Last emitted row per key across the update-mode batches."""
    out = read_batches(spark, run)
    cols = [f.name for f in run.schema if f.name not in keys]
    latest = out.groupBy(*keys).agg(F.max_by(F.struct(*cols), "batch").alias("r"))
    return latest.select(*keys, "r.*")


def saved_state(spark: SparkSession, run: Run, key: str, value: str) -> DataFrame:
    """The keyed state of a stopped query, read from its checkpoint; ``key`` and ``value`` name the
    columns and types as the next query wants them.  None, if the query never ran a batch."""
    names = [c.split() for c in (key, value)]
    if not path_exists(spark, os.path.join(run.checkpoint, "state")):
        return spark.createDataFrame([], f"{key}, {value}")
    state = spark.read.format("statestore").load(run.checkpoint)
    return state.select(*[F.col(side)[state.schema[side].dataType.names[0]].cast(kind).alias(name)
                          for side, (name, kind) in zip(("key", "value"), names)])
