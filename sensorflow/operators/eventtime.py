"""Event time: per-record watermark traces and late-data classification.

The reference's rules, in milliseconds of event time ``ts * 1000``:

* watermark after a record = max event time seen so far - delay - 1 ms
  (bounded out-of-orderness; delay 0 = monotonous);
* a window [start, end) fires once the watermark reaches end - 1 ms;
* with allowed lateness L the window is destroyed once the watermark reaches
  end - 1 ms + L; a row arriving for a destroyed window goes to the late
  side output, a row arriving between firing and destruction re-fires it;
* a row is late for a join when its event time < the current watermark.

"The watermark when a row arrives" is a global running max over arrival
order -- computed with the two-level scan (maximum per range of the arrival
order, carried over the ranges), never with an un-partitioned window over rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.operators.scan import Agg, running

LONG_MIN = -(2 ** 63)


def watermark_trace(df: DataFrame, delay_s: int, order: list[str], time_col: str = "ts",
                    carry_max: int | None = None) -> DataFrame:
    """Add ``wm_before_ms`` / ``wm_after_ms``: the watermark just before and
    just after each record in arrival ``order`` (punctuated: one per record).
    Before the first record the watermark is Long.MIN_VALUE.  ``carry_max``
    is the max event time of earlier input (e.g. earlier micro-batches)."""
    r = running(df, [], order, [Agg("__max_before", "max", time_col, exclusive=True),
                                Agg("__max_after", "max", time_col)])
    if carry_max is not None:
        r = (r.withColumn("__max_before", F.greatest(F.col("__max_before"), F.lit(carry_max)))
              .withColumn("__max_after", F.greatest(F.col("__max_after"), F.lit(carry_max))))
    d = delay_s * 1000 + 1
    before = F.when(F.col("__max_before").isNull(), F.lit(LONG_MIN)) \
        .otherwise(F.col("__max_before") * 1000 - d)
    return (r.withColumn("wm_before_ms", before)
             .withColumn("wm_after_ms", F.col("__max_after") * 1000 - d)
             .drop("__max_before", "__max_after"))


def periodic_watermark(df: DataFrame, delay_s: int, period_s: int, arrival: str = "arrival", time_col: str = "ts") -> DataFrame:
    """Add ``wm_before_ms`` as a generator gives it that emits every ``period_s`` seconds of arrival time.

    A record meets the watermark of the last tick at or before its arrival: the maximum over the
    rows that arrived before that tick.  One maximum per tick is carried over the ticks and
    joined back, so a tick that nothing arrives in costs nothing."""
    rows = df.withColumn("__tick", F.floor(F.col(arrival) / period_s))
    per_tick = rows.groupBy("__tick").agg(F.max(time_col).alias("__max"))
    before = running(per_tick, [], ["__tick"], [Agg("__top", "max", "__max", exclusive=True)]).select(
        F.col("__tick").alias("__t"), "__top")
    wm = F.when(F.col("__top").isNull(), F.lit(LONG_MIN)).otherwise(F.col("__top") * 1000 - (delay_s * 1000 + 1))
    return (rows.join(before, F.col("__tick").eqNullSafe(F.col("__t")), "left").withColumn("wm_before_ms", wm)
            .drop("__tick", "__t", "__top"))


def idle_watermark(df: DataFrame, delay_s: int, idle_s: int, source: str, sources: list, order: list[str],
                   arrival: str = "arrival", time_col: str = "ts", carry: Callable = running) -> DataFrame:
    """Add ``wm_before_ms``, the watermark of several inputs of which idle ones do not hold it back.

    An input is idle for a record when its own last row (or, before its first, the first row of all)
    arrived more than ``idle_s`` seconds before.  Progress is the minimum of the latest times of
    the inputs that are not idle; while one of these has no row yet there is none.  The watermark never
    goes back, also not when an idle input returns."""
    rows = df
    aggs = [Agg("__begin", "min", arrival)]
    for i, s in enumerate(sources):
        mine = F.col(source).eqNullSafe(F.lit(s))
        rows = (rows.withColumn(f"__t{i}", F.when(mine, F.col(time_col))).withColumn(f"__a{i}", F.when(mine, F.col(arrival))))
        aggs += [Agg(f"__top{i}", "max", f"__t{i}", exclusive=True), Agg(f"__last{i}", "max", f"__a{i}", exclusive=True)]
    r = carry(rows, [], order, aggs)
    now = F.col(arrival)
    awake = [now - F.coalesce(f"__last{i}", "__begin") <= idle_s for i in range(len(sources))]
    silent = F.lit(False)  # an input that may still come with anything
    for i, a in enumerate(awake):
        silent = silent | (a & F.col(f"__top{i}").isNull())
    tops = F.array_min(F.array_compact(F.array(*[F.when(a, F.col(f"__top{i}")) for i, a in enumerate(awake)])))
    r = r.withColumn("__min", F.when(~silent, tops))
    made = [f"__{x}{i}" for i in range(len(sources)) for x in ("t", "a", "top", "last")]
    r = carry(r.drop(*made, "__begin"), [], order, [Agg("__wm", "max", "__min")])
    wm = F.when(F.col("__wm").isNull(), F.lit(LONG_MIN)).otherwise(F.col("__wm") * 1000 - (delay_s * 1000 + 1))
    return r.withColumn("wm_before_ms", wm).drop("__min", "__wm")


def classify_window_lateness(df: DataFrame, size_s: int, delay_s: int, lateness_s: int,
                             order: list[str], time_col: str = "ts",
                             carry_max: int | None = None) -> DataFrame:
    """Per row: its tumbling window and whether it arrived ``on_time``,
    ``refire`` (after the window fired, within allowed lateness) or ``late``
    (window already destroyed -> side output)."""
    tr = watermark_trace(df, delay_s, order, time_col, carry_max)
    start = F.col(time_col) - F.pmod(F.col(time_col), F.lit(size_s))
    end_ms = (start + size_s) * 1000
    wm = F.col("wm_before_ms")
    status = (F.when(wm >= end_ms - 1 + lateness_s * 1000, F.lit("late"))
              .when(wm >= end_ms - 1, F.lit("refire"))
              .otherwise(F.lit("on_time")))
    return tr.withColumn("win_start", start).withColumn("win_end", start + size_s) \
             .withColumn("status", status)


def late_split(df: DataFrame, size_s: int, delay_s: int, lateness_s: int,
               order: list[str], time_col: str = "ts") -> tuple[DataFrame, DataFrame]:
    """(kept rows, late side output) for a windowed job with allowed lateness."""
    c = classify_window_lateness(df, size_s, delay_s, lateness_s, order, time_col)
    return c.where(F.col("status") != "late"), c.where(F.col("status") == "late")


def allowed_lateness_windows(df: DataFrame, size_s: int, delay_s: int, lateness_s: int,
                             order: list[str], keys: list[str], time_col: str = "ts") -> DataFrame:
    """Final result per keyed window with allowed lateness, plus how many
    times it fired: once when the watermark passed it (if it had on-time
    rows) and once more for every row that arrived late but in time."""
    kept, _ = late_split(df, size_s, delay_s, lateness_s, order, time_col)
    return (kept.groupBy(*keys, "win_start", "win_end")
            .agg(F.count(F.lit(1)).alias("cnt"), F.sum("vc").cast("bigint").alias("vc_sum"),
                 (F.max((F.col("status") == "on_time").cast("int")) +
                  F.sum((F.col("status") == "refire").cast("int"))).cast("bigint").alias("firings")))


def two_input_progress(lmax: int | None, rmax: int | None, delay_s: int) -> int | None:
    """Watermark in ms of a two-input operator from the latest times of both; none until both have one."""
    return None if lmax is None or rmax is None else min(lmax, rmax) * 1000 - (delay_s * 1000 + 1)


def late_rows_two_inputs(left: DataFrame, right: DataFrame, delay_s: int, order: list[str],
                         time_col: str = "ts", carry: tuple[int | None, int | None] = (None, None)) -> DataFrame:
    """Merge two inputs in arrival order and flag rows that are late for a
    two-input operator: its watermark is the minimum of both inputs'
    watermarks (Long.MIN_VALUE until both have produced one).  ``carry``
    holds both inputs' latest times in earlier batches."""
    both = (left.withColumn("side", F.lit("L")).withColumn("__lt", F.col(time_col))
            .withColumn("__rt", F.lit(None).cast("bigint"))
            .unionByName(right.withColumn("side", F.lit("R")).withColumn("__lt", F.lit(None).cast("bigint"))
                         .withColumn("__rt", F.col(time_col))))
    r = running(both, [], order, [Agg("__lmax", "max", "__lt", exclusive=True),
                                  Agg("__rmax", "max", "__rt", exclusive=True)])
    for name, top in zip(("__lmax", "__rmax"), carry):
        if top is not None:
            r = r.withColumn(name, F.greatest(F.col(name), F.lit(top)))
    wm = F.least(F.col("__lmax"), F.col("__rmax")) * 1000 - (delay_s * 1000 + 1)
    has_wm = F.col("__lmax").isNotNull() & F.col("__rmax").isNotNull()
    late = F.coalesce(has_wm & (F.col(time_col) * 1000 < wm), F.lit(False))
    return r.withColumn("late", late).drop("__lt", "__rt", "__lmax", "__rmax")
