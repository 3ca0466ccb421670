"""What a ``foreachBatch`` query keeps between its micro-batches.

* ``KeyedLog``: one state per key, written by change.  A batch writes the states of its own
  keys as one segment.  Every ``fan`` segments of a size are merged into one of the next size,
  newest state per key, so a state is rewritten about log(batches) times and a read opens
  about ``fan`` x log(batches) segments.
* ``RowLog``: rows that wait for time to pass, one folder per batch, written once.  A
  folder goes when none of its rows is needed any more.
* ``Ledger``: a few values per batch.

Everything is a function of the batch id.  A batch that is run again after a failure reads
what it read before and writes over what it wrote; what a batch makes superfluous is
deleted only when the next batch begins, that is when it will not be run again.
"""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.operators.scan import KEY
from sensorflow.session import remove_path


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table that no Python worker has to be started for."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


class KeyedLog:
    """States of keys: rows of ``key`` (one column, null-safe inside a struct) and state columns."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str = KEY, fan: int = 8):
        self.spark, self.path, self.schema, self.key, self.fan = spark, path, schema, key, fan

    def segments(self, batches: int) -> list[tuple[int, int]]:
        """The live segments [from, to) after so many batches, oldest first."""
        out, at, size = [], 0, 1
        while size * self.fan <= batches:
            size *= self.fan
        while size:
            while at + size <= batches:
                out.append((at, at + size))
                at += size
            size //= self.fan
        return out

    def _folder(self, segment: tuple[int, int]) -> str:
        return os.path.join(self.path, f"{segment[0]}-{segment[1]}")

    def _segment(self, segment: tuple[int, int]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self._folder(segment))

    def _newest(self, segments: list[tuple[int, int]], keys: DataFrame | None) -> DataFrame:
        """The newest state of each key (of those in ``keys``) in some neighbouring segments."""
        parts = [self._segment(s) for s in segments]
        if keys is not None:
            parts = [p.join(keys, self.key, "left_semi") for p in parts]
        if len(parts) == 1:
            return parts[0]
        every = parts[0].withColumn("__at", F.lit(segments[0][0]))
        for p, s in zip(parts[1:], segments[1:]):
            every = every.union(p.withColumn("__at", F.lit(s[0])))
        states = [f.name for f in self.schema if f.name != self.key]
        newest = every.groupBy(self.key).agg(F.max_by(F.struct(*states), "__at").alias("__state"))
        return newest.select(*[F.col(f.name) if f.name == self.key else F.col("__state")[f.name].alias(f.name) for f in self.schema])

    def read(self, batches: int, keys: DataFrame | None = None) -> DataFrame:
        """States after so many batches; ``keys``: one column named like the key, repeats allowed."""
        segments = self.segments(batches)
        if not segments:
            return no_rows(self.spark, self.schema)
        return self._newest(segments, keys)

    def write(self, batch: int, changed: DataFrame, gone: Column | None = None) -> None:
        """The states that ``batch`` changed, one row per key.

        ``gone`` tells which states will never matter again; merges leave them out.
        """
        for segment in set(self._made(batch - 1)) - set(self.segments(batch)):
            remove_path(self.spark, self._folder(segment))
        changed.select(*self.schema.names).write.mode("overwrite").parquet(self._folder((batch, batch + 1)))
        size = self.fan
        while (batch + 1) % size == 0:
            step = size // self.fan
            first = batch + 1 - size
            merged = self._newest([(s, s + step) for s in range(first, batch + 1, step)], None)
            if gone is not None:
                merged = merged.where(~F.coalesce(gone, F.lit(False)))
            merged.write.mode("overwrite").parquet(self._folder((first, batch + 1)))
            size *= self.fan

    def _made(self, batch: int) -> Iterable[tuple[int, int]]:
        """Segments that the merges of ``batch`` took in."""
        size = self.fan
        while batch >= 0 and (batch + 1) % size == 0:
            step = size // self.fan
            yield from ((s, s + step) for s in range(batch + 1 - size, batch + 1, step))
            size *= self.fan


class RowLog:
    """Rows in a folder per batch."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema

    def folder(self, batch: int) -> str:
        return os.path.join(self.path, f"batch{batch}")

    def write(self, batch: int, rows: DataFrame) -> None:
        rows.select(*self.schema.names).write.mode("overwrite").parquet(self.folder(batch))

    def read(self, batches: Iterable[int]) -> DataFrame:
        paths = [self.folder(b) for b in batches]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def drop(self, batches: Iterable[int]) -> None:
        for b in batches:
            remove_path(self.spark, self.folder(b))


class Ledger:
    """One row of values per batch; the values before the first batch are ``start``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, start: dict):
        self.spark, self.path, self.schema, self.start = spark, path, schema, start

    def read(self, batch: int) -> dict:
        if batch < 0:
            return dict(self.start)
        return self.spark.read.schema(self.schema).parquet(os.path.join(self.path, f"batch{batch}")).first().asDict(recursive=True)

    def write(self, batch: int, values: dict) -> None:
        names = T._parse_datatype_string(self.schema).names
        row = self.spark.createDataFrame([tuple(values[n] for n in names)], self.schema)
        row.coalesce(1).write.mode("overwrite").parquet(os.path.join(self.path, f"batch{batch}"))
