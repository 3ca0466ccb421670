"""Top-N operators.

``row_number() <= N`` over a partition lets Spark insert a partial
``WindowGroupLimit`` before the shuffle, so each map task sends at most N
rows per group even for a hot group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.operators.scan import Agg, dealt, running
from sensorflow.operators.windows import sliding


def window_counts(df: DataFrame, size_s: int, slide_s: int, value: str = "vc", time_col: str = "t") -> DataFrame:
    """How often each value occurs per sliding window; also on a stream with a watermark."""
    return sliding(df, size_s, slide_s, [value], time_col, aggs=[F.count(F.lit(1)).alias("cnt")])


def first_n(counts: DataFrame, n: int = 2, value: str = "vc") -> DataFrame:
    """The N most frequent values of each window, ties to the smaller value.  A task keeps at
    most N rows per window before and after the shuffle, however many values there are."""
    w = Window.partitionBy("win_start", "win_end").orderBy(F.desc("cnt"), F.asc(value))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def topn_per_window(df: DataFrame, size_s: int, slide_s: int, n: int = 2,
                    value: str = "vc", time_col: str = "t") -> DataFrame:
    """Per sliding window (all keys together): the N most frequent values.
    A stream cuts each micro-batch of finished counts with ``first_n``."""
    return first_n(window_counts(df, size_s, slide_s, value, time_col), n, value)


def running_topk(df: DataFrame, k: int = 3, key: str = "id", value: str = "vc",
                 order: list[str] | None = None, scan: Callable = running) -> DataFrame:
    """At every record, the k largest values of the key so far (descending,
    duplicates kept) -- list state sorted and cut after each add."""
    r = scan(df.select("seq", key, value, *dealt(df)), [key], order or ["seq"], [Agg("top", "topk", value, k=k)])
    return r.select("seq", key, value, "top")


def top2_table_aggregate(df: DataFrame, value: str = "vc", keys: list[str] | None = None,
                         n: int = 2) -> DataFrame:
    """Table aggregate Top2: rows (value, rank) of the two largest values per
    group.  The accumulator starts at (0, 0), so only positive values can
    enter and a repeated maximum fills both ranks."""
    keys = keys or []
    pos = df.where(F.col(value) > 0)
    if not keys:
        top = pos.select(F.col(value).alias("value")).orderBy(F.desc("value")).limit(n)
        return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("value"))))
    w = Window.partitionBy(*keys).orderBy(F.desc("value"))
    return (pos.select(*keys, F.col(value).alias("value"))
            .withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= n))


def top_changelog(df: DataFrame, value: str = "vc", key: str = "id", n: int = 2, order: list[str] | None = None,
                  scan: Callable = running) -> DataFrame:
    """Table aggregate Top-N as an updating table: what each record changes in the key's ranks.

    A rank that gets its first value inserts it (+I); a rank whose value changes takes the old
    one back (-U) and gives the new one (+U); a record that changes no rank gives nothing.
    The accumulator starts at zeros, so only positive values enter and a repeated maximum
    fills both ranks.  ``pos`` orders the rows of one record."""
    rows = df.select("seq", key, value, *dealt(df)).withColumn("__v", F.when(F.col(value) > 0, F.col(value)))
    r = scan(rows, [key], order or ["seq"], [Agg("__before", "topk", "__v", k=n, exclusive=True)])
    after = F.slice(F.sort_array(F.concat("__before", F.array_compact(F.array("__v"))), asc=False), 1, n)
    r = r.where(F.col("__v").isNotNull()).withColumn("__after", after)

    def change(i: int):
        old, new = F.get("__before", F.lit(i)), F.get("__after", F.lit(i))

        def row(pos: int, op: str, v):
            return F.struct(F.lit(2 * i + pos).alias("pos"), F.lit(op).alias("op"), v.alias("value"), F.lit(i + 1).alias("rank"))
        return F.when(new.isNotNull() & old.isNull(), F.array(row(1, "+I", new))).when(
            old != new, F.array(row(0, "-U", old), row(1, "+U", new)))
    return r.select("seq", key, F.explode(F.array_compact(F.array(*[change(i) for i in range(n)]))).alias("__c")).select(
        "seq", key, F.inline("__c"))
