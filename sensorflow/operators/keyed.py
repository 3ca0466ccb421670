"""Keyed aggregation.

Final aggregates (batch result / streaming complete-update output) are plain
``groupBy().agg()``: Spark runs them as partial (map-side) + final hash
aggregates, so a hot key ships one partial row per map task.

Running aggregates (a stream's per-record output replayed on a table) go
through :func:`sensorflow.operators.scan.running`, which splits hot keys
across tasks instead of ``Window.partitionBy(key)``.  ``scan`` lets a stream
put in a scan that goes on from earlier batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.operators.scan import Agg, dealt, running

ORDER = ["seq"]


# ---- final -----------------------------------------------------------------

def word_count(words: DataFrame, col: str = "word") -> DataFrame:
    return words.groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))


def group_sum(df: DataFrame, key: str = "id", col: str = "vc", name: str = "sum_vc") -> DataFrame:
    return df.groupBy(key).agg(F.sum(col).cast("bigint").alias(name))


def filter_group_sum(df: DataFrame, threshold: int = 5) -> DataFrame:
    """where(vc > threshold).groupBy(id).sum(vc) -- the minimum slice."""
    return group_sum(df.where(F.col("vc") > threshold))


# ---- running (one output row per input row) --------------------------------

def _rows(df: DataFrame) -> DataFrame:
    return df.select("seq", "id", "ts", "vc", *dealt(df))


def running_reduce(df: DataFrame, order: list[str] = ORDER, scan: Callable = running) -> DataFrame:
    """reduce((a, b) -> (a.id, b.ts, a.vc + b.vc)): the first record passes
    unchanged, later ones carry the newest ts and the vc sum so far."""
    r = scan(_rows(df), ["id"], order, [Agg("vc_sum", "sum", "vc")])
    return r.select("seq", "id", "ts", F.col("vc_sum").alias("vc"))


def running_sum(df: DataFrame, order: list[str] = ORDER, scan: Callable = running) -> DataFrame:
    """sum("vc"): vc summed, every other field kept from the key's first record."""
    r = scan(_rows(df), ["id"], order, [Agg("vc_sum", "sum", "vc"), Agg("ts0", "first", "ts")])
    return r.select("seq", "id", F.col("ts0").alias("ts"), F.col("vc_sum").alias("vc"))


def running_extreme(df: DataFrame, kind: str = "max", order: list[str] = ORDER) -> DataFrame:
    """max/min("vc"): only vc follows the extreme; other fields stay from the first record."""
    r = running(_rows(df), ["id"], order, [Agg("vc_x", kind, "vc"), Agg("ts0", "first", "ts")])
    return r.select("seq", "id", F.col("ts0").alias("ts"), F.col("vc_x").cast("int").alias("vc"))


def running_extreme_by(df: DataFrame, kind: str = "max_by", order: list[str] = ORDER) -> DataFrame:
    """maxBy/minBy("vc"): the whole record holding the extreme (earliest wins ties)."""
    r = running(_rows(df), ["id"], order, [Agg("ts_x", kind, "ts", by="vc"), Agg("vc_x", kind, "vc", by="vc")])
    return r.select("seq", "id", F.col("ts_x").alias("ts"), F.col("vc_x").alias("vc"))


def running_avg(df: DataFrame, order: list[str] = ORDER, scan: Callable = running) -> DataFrame:
    """Running mean of vc with a (sum, count) accumulator."""
    r = scan(_rows(df), ["id"], order, [Agg("s", "sum", "vc"), Agg("n", "count")])
    return r.select("seq", "id", "vc", (F.col("s") / F.col("n")).alias("avg_vc"))
