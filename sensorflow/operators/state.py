"""Batch twins of the keyed-state jobs (value / map / list state, TTL).

Each is the per-record output the stateful stream would print, computed as
running scans over the key's records in arrival order.  The streaming
versions (``transformWithState``) live in ``sensorflow.streaming.processors``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.operators.scan import Agg, dealt, running


def delta_alert(df: DataFrame, limit: int = 10, order: list[str] | None = None,
                scan: Callable = running) -> DataFrame:
    """Value state holding the previous vc (none -> 0): alert when
    |vc - previous| > limit."""
    r = scan(df.select("seq", "id", "vc", *dealt(df)), ["id"], order or ["seq"],
             [Agg("prev_vc", "last", "vc", exclusive=True)])
    r = r.withColumn("prev_vc", F.coalesce(F.col("prev_vc"), F.lit(0)))
    hits = r.where(F.abs(F.col("vc") - F.col("prev_vc")) > limit)
    return hits.select("seq", "id", "vc", "prev_vc", F.concat(
        F.col("id"), F.lit(" went from "), F.col("prev_vc").cast("string"), F.lit(" to "),
        F.col("vc").cast("string"), F.lit(f", by more than {limit}")).alias("message"))


def vc_count_map(df: DataFrame) -> DataFrame:
    """Map state vc -> count per key, as it stands after all records
    (one row per map entry)."""
    return df.groupBy("id", "vc").agg(F.count(F.lit(1)).alias("n"))


def vc_count_running(df: DataFrame, order: list[str] | None = None, scan: Callable = running) -> DataFrame:
    """The map entry updated by each record: its count right after the record."""
    r = scan(df.select("seq", "id", "vc", *dealt(df)), ["id", "vc"], order or ["seq"], [Agg("n", "count")])
    return r.select("seq", "id", "vc", "n")


def ttl_last_value(df: DataFrame, ttl_s: int, write_above: int = 10, time_col: str = "ts",
                   order: list[str] | None = None, scan: Callable = running) -> DataFrame:
    """Value state with time-to-live, refreshed on read and on write, never
    returning expired values; written only when vc > write_above.

    Every record reads the state, so the state survives to record r exactly
    when the last write w happened before r and no two consecutive records of
    the key in (w, r] are ``ttl_s`` or more apart (expired when
    last_access + ttl <= now).  Time is the record's event time.  Records are
    processed in ``seq`` order (break and write positions are compared by
    ``seq``), so ``order`` may only be ``["seq"]``."""
    order = order or ["seq"]
    if order != ["seq"]:
        raise ValueError("ttl_last_value processes records in seq order")
    base = df.select("seq", "id", time_col, "vc", *dealt(df))
    s1 = scan(base, ["id"], order, [Agg("__prev_t", "last", time_col, exclusive=True)], keep=True)
    s1 = (s1.withColumn("__brk", F.when(F.col("__prev_t").isNotNull() &
                                        (F.col(time_col) - F.col("__prev_t") >= ttl_s), F.col("seq")))
            .withColumn("__w", F.when(F.col("vc") > write_above, F.col("seq")))
            .withColumn("__wv", F.when(F.col("vc") > write_above, F.col("vc"))))
    # the time of the last access is the first state of both scans: a stream drops expired keys by it
    s2 = scan(s1, ["id"], order, [Agg("__seen", "last", time_col),
                                      Agg("__last_w", "last", "__w", exclusive=True),
                                      Agg("__last_wv", "last", "__wv", exclusive=True),
                                      Agg("__last_brk", "last", "__brk")])
    alive = F.col("__last_w").isNotNull() & (F.col("__last_brk").isNull() |
                                             (F.col("__last_brk") <= F.col("__last_w")))
    return s2.select("seq", "id", time_col, "vc",
                     F.when(alive, F.col("__last_wv")).alias("state"))
