"""Windows: time (tumbling / sliding), session (fixed / per-record gap),
count (tumbling / sliding), global and un-keyed.

Bounds are returned as epoch seconds (``win_start``, ``win_end``), half-open
``[start, end)``.  Time windows use Spark's ``window`` grouping expression, so
they run as partial + final hash aggregation (a hot key is pre-aggregated on
the map side).  Sessions and count windows need an order inside the key;
they use the skew-proof running scan and then group by a bounded window id.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.scalar import epoch_ms_format
from sensorflow.operators.scan import Agg, dealt, running


def _secs(c: Column) -> Column:
    return F.unix_seconds(c)


def _interval(seconds: int) -> str:
    return f"{int(seconds)} seconds"


def with_bounds(grouped: DataFrame, wcol: str = "w") -> DataFrame:
    cols = [c for c in grouped.columns if c != wcol]
    return grouped.select(_secs(F.col(f"{wcol}.start")).alias("win_start"),
                          _secs(F.col(f"{wcol}.end")).alias("win_end"), *cols)


def default_aggs() -> list[Column]:
    return [F.count(F.lit(1)).alias("cnt"), F.sum("vc").cast("bigint").alias("vc_sum")]


def tumbling(df: DataFrame, size_s: int, keys: list[str] | None = None, time_col: str = "t",
             aggs: list[Column] | None = None) -> DataFrame:
    keys = keys or []
    g = df.groupBy(F.window(time_col, _interval(size_s)).alias("w"), *keys)
    return with_bounds(g.agg(*(aggs or default_aggs())))


def sliding(df: DataFrame, size_s: int, slide_s: int, keys: list[str] | None = None,
            time_col: str = "t", aggs: list[Column] | None = None) -> DataFrame:
    keys = keys or []
    g = df.groupBy(F.window(time_col, _interval(size_s), _interval(slide_s)).alias("w"), *keys)
    return with_bounds(g.agg(*(aggs or default_aggs())))


def window_reduce(df: DataFrame, size_s: int, keys: list[str] | None = None) -> DataFrame:
    """reduce((a, b) -> (a.id, b.ts, a.vc + b.vc)) per window: newest ts, vc sum."""
    return tumbling(df, size_s, keys or ["id"],
                    aggs=[F.max_by("ts", "seq").alias("ts"), F.sum("vc").cast("bigint").alias("vc")])


def window_aggregate(df: DataFrame, size_s: int, keys: list[str] | None = None) -> DataFrame:
    """Aggregate with distinct in/acc/out types: int accumulator, string result."""
    return tumbling(df, size_s, keys or ["id"],
                    aggs=[F.sum("vc").cast("bigint").cast("string").alias("result")])


def _bounds_label(key: Column, cnt: Column) -> Column:
    start = epoch_ms_format(F.col("win_start") * 1000)
    end = epoch_ms_format(F.col("win_end") * 1000)
    return F.concat(key, F.lit(" in ["), start, F.lit(" .. "), end,
                    F.lit("): "), cnt.cast("string"), F.lit(" rows"))


def window_process(df: DataFrame, size_s: int, key: str = "id") -> DataFrame:
    """Full-window function: key, bounds, element count (and vc range) per window.

    The rows themselves come from :func:`window_elements`."""
    w = tumbling(df, size_s, [key], aggs=[F.count(F.lit(1)).alias("cnt"),
                                          F.min("vc").alias("vc_min"), F.max("vc").alias("vc_max")])
    return w.withColumn("label", _bounds_label(F.col(key), F.col("cnt")))


def window_elements(df: DataFrame, size_s: int, key: str = "id", time_col: str = "ts",
                    fn: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Full-window function with the window's elements: every row with the
    bounds and the row count of its (key, window), then ``fn`` over those rows.

    The count is aggregated first and joined back; no window is ever a list."""
    start = F.col(time_col) - F.pmod(F.col(time_col), F.lit(size_s))
    rows = df.withColumn("win_start", start)
    counts = rows.groupBy(F.col(key).alias("__k"), F.col("win_start").alias("__w")).agg(F.count(F.lit(1)).alias("cnt"))
    out = (rows.join(counts, F.col(key).eqNullSafe(F.col("__k")) & F.col("win_start").eqNullSafe(F.col("__w")))
           .drop("__k", "__w").withColumn("win_end", F.col("win_start") + size_s))
    return fn(out) if fn else out


def window_agg_with_bounds(df: DataFrame, size_s: int, key: str = "id") -> DataFrame:
    """Incremental aggregate handed to a window function that adds the bounds."""
    w = tumbling(df, size_s, [key], aggs=[F.sum("vc").cast("bigint").cast("string").alias("result")])
    return w.withColumn("label", _bounds_label(F.col(key), F.lit(1)))


# ---- sessions ----------------------------------------------------------------

def sessions(df: DataFrame, keys: list[str], gap_s: int | None = None,
             gap_col: Column | None = None, time_col: str = "ts",
             order_tiebreak: str = "seq", aggs: list[Column] | None = None) -> DataFrame:
    """Session windows: each row opens ``[ts, ts + gap)``; overlapping or
    touching windows of a key merge.  ``gap_col`` gives a per-record gap.

    Two running scans (max end before the row, then a running session
    number) followed by a group-by on (key, session) -- no key is ever
    processed by a single task."""
    gap = F.lit(gap_s) if gap_col is None else gap_col
    base = df.withColumn("__end", F.col(time_col) + gap)
    s1 = running(base, keys, [time_col, order_tiebreak], [Agg("__prev_end", "max", "__end", exclusive=True)], keep=True)
    flagged = s1.withColumn("__new", (F.col("__prev_end").isNull() |
                                      (F.col(time_col) > F.col("__prev_end"))).cast("int"))
    s2 = running(flagged, keys, [time_col, order_tiebreak], [Agg("__sno", "sum", "__new")])
    aggs = aggs or default_aggs()
    g = s2.groupBy(*keys, "__sno").agg(F.min(time_col).alias("win_start"),
                                       F.max("__end").alias("win_end"), *aggs)
    return g.drop("__sno")


# ---- count windows -----------------------------------------------------------

def tumbling_places(df: DataFrame, size: int, keys: list[str], order: list[str], scan: Callable = running) -> DataFrame:
    """Each row with the number of the one count window it is in."""
    r = scan(df, keys, order, [Agg("__rn", "count")])
    return r.withColumn("window_no", F.floor((F.col("__rn") - 1) / size).cast("bigint"))


def sliding_places(df: DataFrame, size: int, slide: int, keys: list[str], order: list[str],
                   scan: Callable = running) -> DataFrame:
    """Each row with the numbers of the firings that contain it (at most ceil(size/slide) copies)."""
    r = scan(df, keys, order, [Agg("__rn", "count")])
    # firing numbers f (multiples of slide) with rn <= f <= rn + size - 1
    first_f = F.ceil(F.col("__rn") / slide) * slide
    fires = F.sequence(first_f.cast("bigint"), (F.col("__rn") + size - 1).cast("bigint"),
                       F.lit(slide).cast("bigint"))
    # a window shorter than the slide skips rows: sequence would run backwards
    fires = F.when(first_f <= F.col("__rn") + size - 1, fires).otherwise(F.array().cast("array<bigint>"))
    return r.withColumn("fire_no", F.explode(fires))


def counted(places: DataFrame, keys: list[str], number: str) -> DataFrame:
    """Count windows, complete or not: one row each, with the last row number."""
    return (places.groupBy(*keys, number)
            .agg(F.count(F.lit(1)).alias("cnt"), F.sum("vc").cast("bigint").alias("vc_sum"),
                 F.max("__rn").alias("__last_rn"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq")))


def fired(places: DataFrame, keys: list[str], number: str, full: Column) -> DataFrame:
    """Count windows that are complete (``full``, over cnt and the last row number): one row each."""
    return counted(places, keys, number).where(full).drop("__last_rn")


def count_tumbling(df: DataFrame, size: int, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """countWindow(size): every ``size`` records of a key form one window; an
    incomplete tail never fires."""
    return fired(tumbling_places(df, size, keys, order or ["seq"]), keys, "window_no", F.col("cnt") == size)


def count_sliding(df: DataFrame, size: int, slide: int, keys: list[str],
                  order: list[str] | None = None) -> DataFrame:
    """countWindow(size, slide): fires at every ``slide``-th record of a key
    over its last <= ``size`` records; a firing needs its triggering record."""
    return fired(sliding_places(df, size, slide, keys, order or ["seq"]), keys, "fire_no",
                 F.col("__last_rn") == F.col("fire_no"))


# ---- global / all ---------------------------------------------------------------

def global_window(df: DataFrame, keys: list[str]) -> DataFrame:
    """Never-closing window per key: the whole history."""
    return df.groupBy(*keys).agg(*default_aggs())


@dataclass(frozen=True)
class Trigger:
    """When a global window fires: at every ``every``-th record of a key, or at records for which
    ``when`` holds.  ``purge`` empties the window after a firing, else it keeps its rows."""

    every: int | None = None
    when: Column | None = None
    purge: bool = False


def global_triggers(df: DataFrame, keys: list[str], triggers: dict[str, Trigger], order: list[str] | None = None,
                    scan: Callable = running) -> DataFrame:
    """Global window per key with user triggers, each by itself: one row per trigger and firing, with its
    number and what the window holds then (count and sum over the records up to the firing one, since the last purge).

    Records are taken in ``order``.  All of it is running aggregates, the same two scans for any number of
    triggers: the number of a record decides whether ``every`` fires, the number of firings before a record
    tells which purged content it belongs to."""
    order = order or ["seq"]
    rows, hits = df, []
    for i, t in enumerate(triggers.values()):
        if (t.every is None) == (t.when is None):
            raise ValueError("a trigger fires every so many records or on a condition")
        if t.when is not None:
            rows = rows.withColumn(f"__hit{i}", F.coalesce(t.when, F.lit(False)).cast("int"))
            hits.append(Agg(f"__hits{i}", "sum", f"__hit{i}"))
    purging = [i for i, t in enumerate(triggers.values()) if t.purge]
    r = scan(rows, keys, order, [Agg("__rn", "count"), Agg("__all", "sum", "vc"), *hits], keep=bool(purging))
    fires = [F.col("__rn") % t.every == 0 if t.every else F.col(f"__hit{i}") == 1 for i, t in enumerate(triggers.values())]
    number = [F.floor(F.col("__rn") / t.every) if t.every else F.col(f"__hits{i}") for i, t in enumerate(triggers.values())]
    some = fires[0]
    for x in fires[1:]:
        some = some | x
    r = r.where(some)
    if purging:
        # what the window held at the firing before is what was purged
        for i in purging:
            r = r.withColumn(f"__cnt{i}", F.when(fires[i], F.col("__rn"))).withColumn(f"__sum{i}", F.when(fires[i], F.col("__all")))
        r = scan(r, keys, order, [Agg(f"__old_{x}{i}", kind, f"__{x}{i}", exclusive=True) for i in purging
                                  for x, kind in (("cnt", "max"), ("sum", "last"))])

    def firing(i: int, name: str) -> Column:
        cnt, total = F.col("__rn"), F.col("__all")
        if i in purging:
            cnt, total = cnt - F.coalesce(f"__old_cnt{i}", F.lit(0)), total - F.coalesce(f"__old_sum{i}", F.lit(0))
        return F.when(fires[i], F.struct(F.lit(name).alias("trigger"), number[i].cast("bigint").alias("firing"),
                                         cnt.cast("bigint").alias("cnt"), total.cast("bigint").alias("vc_sum")))
    every = F.array_compact(F.array(*[firing(i, name) for i, name in enumerate(triggers)]))
    return r.select(*keys, *order, F.inline(every))


def global_trigger(df: DataFrame, keys: list[str], trigger: Trigger, order: list[str] | None = None,
                   scan: Callable = running) -> DataFrame:
    """:func:`global_triggers` with one trigger."""
    return global_triggers(df, keys, {"": trigger}, order, scan).drop("trigger")


def triggers_compared(df: DataFrame, every: int, above: int, scan: Callable = running) -> DataFrame:
    """Firings of four triggers on the same global window: by count and by condition, keeping and purging."""
    kinds = {"count keep": Trigger(every=every), "count purge": Trigger(every=every, purge=True),
             "condition keep": Trigger(when=F.col("vc") > above), "condition purge": Trigger(when=F.col("vc") > above, purge=True)}
    fired = global_triggers(df.select("seq", "id", "vc", *dealt(df)), ["id"], kinds, scan=scan)
    return fired.select("trigger", "id", "seq", "firing", "cnt", "vc_sum")


def all_window(df: DataFrame, size_s: int, time_col: str = "t") -> DataFrame:
    """Un-keyed tumbling window; partial aggregation keeps it parallel."""
    return tumbling(df, size_s, [], time_col)
