"""Running (prefix) aggregates per key in a total order, without one task per key.

``Window.partitionBy(key).orderBy(seq)`` puts every row of a key into one
task; with one key holding a third of the data that is one task reading a
third of the cluster's input.  ``running`` works on two levels, all of it in
native expressions and lazy:

1. the order is cut into ranges of its first column, between quantiles of the
   column (a scalar subquery of the same plan), one for about ``BUCKET_ROWS`` rows;
2. ``groupBy(key, bucket)`` reduces each bucket of a key to one state, with
   partial aggregation on the map side;
3. a window over the few states of a key carries them forward: the state of
   all rows in earlier buckets;
4. the carry stands as a row of its own before the rows of its (key, bucket), and a
   window over (key, bucket) runs through the rows of one bucket only.

A hot key is spread over its buckets, and an un-keyed scan over all buckets.
Rows that tie in the first order column share a bucket.

Supported aggregates (``Agg.kind``): sum, count, max, min, first, last (last
non-null), max_by / min_by (first row wins ties), topk (k largest values,
descending, duplicates kept).  Types are Spark's own: sums widen as
``sum`` does and raise on overflow, extremes take any orderable type.
``exclusive=True`` gives the value over the rows *before* the current one
(lag, "watermark before this row").
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY, BUCKET, ROW = "__key", "__bucket", "__row"
PLACE, CUTS = "__place", "__cuts"
BEFORE = -2  # the bucket of states from earlier input
BUCKETS, PARTS, BUCKET_ROWS = 4096, 32, 1 << 16
GROUP_CUTS, TASK_GROUPS = 256, 1024


@dataclass(frozen=True)
class Agg:
    name: str                 # output column
    kind: str                 # see module doc
    col: str | None = None    # input value column (None for count)
    by: str | None = None     # ordering column of max_by / min_by
    k: int = 0                # size of topk
    exclusive: bool = False   # value over the preceding rows only


def _number(c: Column, kind: T.DataType) -> Column:
    """An order column as an exact number that sorts the same way."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, T.IntegralType):
        return c.cast("bigint")
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return c
    raise ValueError(f"running aggregates need a numeric or time order, not {kind.simpleString()}")


def _place(df: DataFrame, order: list[str], negate: bool) -> list[Column]:
    kinds = [df.schema[o].dataType for o in order]
    cols = [_number(F.col(o), k) for o, k in zip(order, kinds)]
    if negate:  # of a whole number ~x, as -x may be out of range
        cols = [-c if isinstance(k, (T.DoubleType, T.FloatType, T.DecimalType)) else F.bitwise_not(c) for c, k in zip(cols, kinds)]
    return [c.alias(f"o{i}") for i, c in enumerate(cols)]


def _input(a: Agg, df: DataFrame, order: list[str]) -> tuple[str, Column]:
    """The aggregate as sum / max / min of one value per row; records compare by their first fields."""
    c = F.col(a.col) if a.col else F.lit(1)
    if a.kind in ("sum", "max", "min"):
        return a.kind, c
    if a.kind == "count":
        return "sum", F.lit(1).cast("bigint")
    if a.kind in ("first", "last"):
        rec = F.struct(*_place(df, order, False), c.alias("v"))
        return ("min" if a.kind == "first" else "max"), F.when(c.isNotNull(), rec)
    if a.kind in ("max_by", "min_by"):
        by = F.col(a.by)
        # ties of ``by`` go to the earliest row: the largest negated place, or the smallest place
        rec = F.struct(by.alias("b"), *_place(df, order, a.kind == "max_by"), c.alias("v"))
        return a.kind[:3], F.when(by.isNotNull(), rec)
    raise ValueError(a.kind)


FOLD = {"sum": F.sum, "max": F.max, "min": F.min}


def _as(op: str, x: Column, kind: T.DataType) -> Column:
    """A sum stays in the type of the state, which a sum of sums may widen; extremes have it already."""
    return x.cast(kind) if op == "sum" else x


def key_column(keys: list[str]) -> Column:
    """The keys as one null-safe column."""
    return (F.struct(*[F.col(k) for k in keys]) if keys else F.lit(0)).alias(KEY)


def with_buckets(df: DataFrame, keys: list[str], order: list[str], buckets: int | None = None) -> DataFrame:
    """Adds the key (null-safe, one column) and the bucket of each row's place in the order.

    The order is cut at quantiles of its first column, each part into buckets of equal width.
    A part holds about 1 / ``PARTS`` of the rows wherever they lie, and both ends are parts of
    their own: a far-off place (a sentinel date, an epoch-0 row) widens no bucket but its own.
    Without ``buckets`` there is one for about ``BUCKET_ROWS`` rows, and at most ``BUCKETS``: more would
    split the keys that are not hot as well, down to a state for every row.

    Rows that come with a bucket (:func:`dealt`: a staged stream's ranges of the same order) keep it."""
    if BUCKET in df.columns:
        return df.withColumn(KEY, key_column(keys))
    x = _number(F.col(order[0]), df.schema[order[0]].dataType).cast("double")
    parts = min(PARTS, buckets or BUCKETS)
    ends = 1 / (4 * (buckets or BUCKETS))
    # arrays as one literal each, not as one for every number
    shares = F.lit(np.array([ends, *(i / parts for i in range(1, parts)), 1 - ends]))
    # quantiles of the rows of groups of tasks, then of these by weight: no step gathers more than its group's few numbers
    steps = F.lit(np.arange(1, GROUP_CUTS) / GROUP_CUTS)
    groups = (df.select(x.alias("x"), (F.spark_partition_id() % TASK_GROUPS).alias("p")).where("x IS NOT NULL").groupBy("p")
              .agg(F.percentile_approx("x", steps, 4 * GROUP_CUTS).alias("c"), F.count(F.lit(1)).alias("n")))
    # the cuts and how many rows there are
    cuts = (groups.select(F.explode("c").alias("c"), (F.col("n") / F.size("c")).alias("part"), "n")
            .agg(F.percentile("c", shares, F.col("n")).alias("c"), F.sum("part").alias("n")).select(F.struct("c", "n"))).scalar()
    # a sum of comparisons with every cut would be too long a method to be compiled
    part = F.size(F.filter(F.col(CUTS)["c"], lambda c: c <= F.col(PLACE)))
    rows = (df.withColumn(KEY, key_column(keys)).withColumn(PLACE, x).withColumn(CUTS, cuts)
            .withColumn(BUCKET, F.when(F.col(PLACE).isNull() | F.col(CUTS)["c"].isNull(), F.lit(-1)).otherwise(part)))
    x = F.col(PLACE)
    low, high = F.get(F.col(CUTS)["c"], F.col(BUCKET) - 1), F.get(F.col(CUTS)["c"], F.col(BUCKET))
    if buckets is None:
        wanted = F.least(F.greatest(F.floor(F.col(CUTS)["n"] / BUCKET_ROWS), F.lit(1)), F.lit(BUCKETS)).cast("int")
        width = F.floor(wanted / parts).cast("int")
    else:
        wanted, width = F.lit(buckets), F.lit(max(1, buckets // parts))
    inside = F.floor((x - low) / F.nullif(high - low, F.lit(0.0)) * width)
    inside = F.coalesce(F.greatest(F.least(inside, width - 1), F.lit(0)), F.lit(0)).cast("int")
    # fewer buckets than parts: neighbouring parts are one bucket
    at = F.when(width > 0, F.col(BUCKET) * width + inside).otherwise(F.floor(F.col(BUCKET) * wanted / (parts + 2)).cast("int"))
    # rows without a place come first, as they do in the sort
    return rows.withColumn(BUCKET, F.when(F.col(BUCKET) < 0, F.lit(-1)).otherwise(at)).drop(PLACE, CUTS)


def dealt(df: DataFrame) -> list[str]:
    """The bucket column, if the rows come with one: an operator that selects its columns keeps it for its scan."""
    return [BUCKET] if BUCKET in df.columns else []


def _plain(aggs: list[Agg]) -> list[Agg]:
    return [a for a in aggs if a.kind != "topk"]


def bucket_states(df: DataFrame, keys: list[str], order: list[str], aggs: list[Agg]) -> DataFrame:
    """One state per key and bucket of rows that come with a bucket: ``states`` of both :func:`running` and :func:`end_states`."""
    rows = df if KEY in df.columns else with_buckets(df, keys, order)
    folds = [(_input(a, rows, order), f"__s{i}") for i, a in enumerate(_plain(aggs))]
    part = rows.groupBy(KEY, BUCKET).agg(F.count(F.lit(1)).alias("__n"), *[FOLD[op](x).alias(s) for (op, x), s in folds])
    return part.drop("__n")


def _states(rows: DataFrame, plain: list[Agg], order: list[str], initial: DataFrame | None,
            states: DataFrame | None) -> tuple[DataFrame, list]:
    """One state per key and bucket; states of earlier input stand in a bucket before all others."""
    parts = [(*_input(a, rows, order), f"__s{i}") for i, a in enumerate(plain)]
    part = bucket_states(rows, [], order, plain) if states is None else states
    if initial is not None:
        part = part.union(initial.select(KEY, F.lit(BEFORE), *[s for _, _, s in parts]))
    return part, parts


def running(df: DataFrame, keys: list[str], order: list[str], aggs: list[Agg], buckets: int | None = None,
            keep: bool = False, initial: DataFrame | None = None, states: DataFrame | None = None) -> DataFrame:
    """Append the running aggregates ``aggs`` per ``keys`` in ``order``.

    ``order`` must be a total order within each key (include a unique column),
    its first column numeric or a time.  The output keeps every input row and
    column.  ``keep=True`` also keeps the key and bucket columns; an input that
    has them is a chained scan and is not dealt again.  ``initial`` holds the
    keys' states after earlier input, as :func:`end_states` gives them, ``states`` the :func:`bucket_states`
    of these rows if they are at hand.
    """
    cols = [c for c in df.columns if c not in (KEY, BUCKET)]
    rows = df if KEY in df.columns else with_buckets(df, keys, order, buckets)
    plain = _plain(aggs)
    if plain:
        part, parts = _states(rows, plain, order, initial, states)
        kinds = part.schema
        # at most ``buckets`` rows per key
        earlier = (Window.partitionBy(KEY).orderBy(BUCKET)
                   .rowsBetween(Window.unboundedPreceding, -1))
        carry = part.select(KEY, BUCKET, *[FOLD[op](s).over(earlier).alias(s) for op, _, s in parts])
        out = _with_carry(rows, cols, [_as(op, x, kinds[n].dataType).alias(n) for op, x, n in parts], carry)
        inside = Window.partitionBy(KEY, BUCKET).orderBy(ROW, *order)
        made = []
        for a, (op, _, s) in zip(plain, parts):
            frame = inside.rowsBetween(Window.unboundedPreceding, -1 if a.exclusive else Window.currentRow)
            so_far = _as(op, FOLD[op](s).over(frame), kinds[s].dataType)
            made.append((so_far if a.kind in ("sum", "count", "max", "min") else so_far["v"]).alias(a.name))
        rows = out.select(KEY, BUCKET, ROW, *cols, *made).where(F.col(ROW) == 1).drop(ROW)
        cols = cols + [a.name for a in plain]
    for j, a in enumerate(a for a in aggs if a.kind == "topk"):
        rows = _topk(rows, cols, order, a, initial, f"__t{j}")
        cols = cols + [a.name]
    names = [c for c in df.columns if c not in (KEY, BUCKET)] + [a.name for a in aggs]
    return rows.select(*([KEY, BUCKET] if keep else []), *names)


def _with_carry(rows: DataFrame, cols: list[str], values: list[Column], carry: DataFrame) -> DataFrame:
    """The rows with their ``values``, and before the rows of a key and bucket its ``carry``, if that holds anything.

    One exchange and one sort bring both together; no table is joined or broadcast."""
    names = [c for c in carry.columns if c not in (KEY, BUCKET)]
    known = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(1)) for c in names])
    none = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in cols]
    return rows.select(KEY, BUCKET, F.lit(1).alias(ROW), *cols, *values).union(
        carry.where(known == 1).select(KEY, BUCKET, F.lit(0).alias(ROW), *none, *names))


def end_states(df: DataFrame, keys: list[str], order: list[str], aggs: list[Agg], buckets: int | None = None,
               initial: DataFrame | None = None, states: DataFrame | None = None) -> DataFrame:
    """One row per key of ``df`` and ``initial``: its states after all rows, for the next call's ``initial``.
    With ``states``, the :func:`bucket_states` of the rows, these are folded instead of the rows.

    Folds need no order, so ``buckets`` plays no part: partial aggregation takes care of hot keys."""
    rows = df if KEY in df.columns else df.withColumn(KEY, key_column(keys))
    parts = [(*_input(a, rows, order), f"__s{i}") for i, a in enumerate(_plain(aggs))]
    if states is None:
        folds = [FOLD[op](x).alias(s) for op, x, s in parts]
        out = rows.groupBy(KEY).agg(F.count(F.lit(1)).alias("__n"), *folds).drop("__n")
    else:
        out = states.select(KEY, *[s for _, _, s in parts])
    if initial is not None or states is not None:
        kinds = out.schema
        both = out if initial is None else out.union(initial.select(KEY, *[s for _, _, s in parts]))
        out = both.groupBy(KEY).agg(F.count(F.lit(1)).alias("__n"), *[_as(op, FOLD[op](s), kinds[s].dataType).alias(s) for op, _, s in parts]).drop("__n")
    for j, a in enumerate(a for a in aggs if a.kind == "topk"):
        state = f"__t{j}"
        values = rows.select(KEY, F.col(a.col).alias("__value"))
        if initial is not None:
            values = values.union(initial.select(KEY, F.explode(state)))
        best = Window.partitionBy(KEY).orderBy(F.col("__value").desc())
        heads = values.where("__value IS NOT NULL").withColumn("__r", F.row_number().over(best)).where(F.col("__r") <= a.k)
        tops = heads.groupBy(KEY).agg(F.sort_array(F.collect_list("__value"), asc=False).alias(state))
        none = F.array().cast(tops.schema[state].dataType)
        out = out.join(tops, KEY, "left").withColumn(state, F.coalesce(state, none))
    return out


def _levels(rows: DataFrame, window, value: Column, k: int, tag: str) -> tuple[DataFrame, list[str], list[str]]:
    """The k largest values so far and those before the row, largest first: each level keeps the larger of what
    it holds and what comes down to it, and hands the other on."""
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    names, helds, down = [], [], f"__{tag}d0"
    rows = rows.withColumn(down, value)
    for j in range(k):
        held, name, nxt = f"__{tag}h{j}", f"__{tag}m{j}", f"__{tag}d{j + 1}"
        rows = rows.withColumn(held, F.max(down).over(before))
        rows = (rows.withColumn(name, F.greatest(held, down))
                .withColumn(nxt, F.when(F.col(held).isNotNull() & F.col(down).isNotNull(), F.least(held, down))))
        names.append(name)
        helds.append(held)
        down = nxt
    return rows, names, helds


def _topk(rows: DataFrame, cols: list[str], order: list[str], a: Agg, initial: DataFrame | None, state: str) -> DataFrame:
    # the k largest of each bucket (at most k rows per key and bucket), run through in bucket order
    best = Window.partitionBy(KEY, BUCKET).orderBy(F.col("__value").desc())
    heads = (rows.where(F.col(a.col).isNotNull()).select(KEY, BUCKET, F.col(a.col).alias("__value"))
             .withColumn("__r", F.row_number().over(best)).where(F.col("__r") <= a.k))
    if initial is not None:
        heads = heads.unionByName(initial.select(KEY, F.lit(BEFORE).alias(BUCKET), F.posexplode(state).alias("__r", "__value"))
                                  .withColumn("__r", F.col("__r") + 1))
    # before its values a bucket meets what the buckets before it hold
    spots = rows.groupBy(KEY, BUCKET).agg(F.lit(None).cast(heads.schema["__value"].dataType).alias("__value"), F.lit(0).alias("__r"))
    over = Window.partitionBy(KEY).orderBy(BUCKET, "__r")
    met, _, helds = _levels(heads.unionByName(spots), over, F.col("__value"), a.k, "c")
    carry = met.where(F.col("__r") == 0).select(KEY, BUCKET, F.explode(F.array(*helds)).alias("__value"))
    out = _with_carry(rows, cols, [F.col(a.col).alias("__value")], carry)
    inside = Window.partitionBy(KEY, BUCKET).orderBy(ROW, *order)
    out, names, helds = _levels(out, inside, F.col("__value"), a.k, "r")
    top = F.array_compact(F.array(*[F.col(n) for n in (helds if a.exclusive else names)])).alias(a.name)
    return out.select(KEY, BUCKET, ROW, *cols, top).where(F.col(ROW) == 1).drop(ROW)
