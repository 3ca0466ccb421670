"""Joins: window, interval, keyed connect, broadcast config, lateral.

Range joins are planned as equi-joins on (key, time bucket): each left row
is copied to the few buckets its interval touches, so no task ever compares
all rows of a hot key with each other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.scalar import java_split
from sensorflow.operators.scan import Agg, dealt, running


def window_join(left: DataFrame, right: DataFrame, size_s: int, key: str = "id",
                time_col: str = "ts") -> DataFrame:
    """Inner join of rows with the same key in the same tumbling window."""
    def win(df, p):
        start = F.col(time_col) - F.pmod(F.col(time_col), F.lit(size_s))
        return df.select(F.col(key), start.alias("win_start"),
                         *[F.col(c).alias(f"{p}_{c}") for c in df.columns if c not in (key, "t")])
    j = win(left, "l").join(win(right, "r"), on=[key, "win_start"], how="inner")
    return j.withColumn("win_end", F.col("win_start") + size_s)


def interval_join(left: DataFrame, right: DataFrame, lower_s: int, upper_s: int,
                  key: str = "id", time_col: str = "ts") -> DataFrame:
    """Pairs with the same key and right.t in [left.t + lower, left.t + upper]
    (both ends inclusive).  Bucketed: bucket width = interval length."""
    width = max(1, upper_s - lower_s)
    lsel = left.select(F.col(key), *[F.col(c).alias(f"l_{c}") for c in left.columns if c not in (key, "t")])
    rsel = right.select(F.col(key), *[F.col(c).alias(f"r_{c}") for c in right.columns if c not in (key, "t")])
    lt = F.col(f"l_{time_col}")
    lb = F.explode(F.sequence(F.floor((lt + lower_s) / width), F.floor((lt + upper_s) / width)))
    lex = lsel.withColumn("__b", lb)
    rex = rsel.withColumn("__b", F.floor(F.col(f"r_{time_col}") / width))
    j = lex.join(rex, on=[key, "__b"], how="inner")
    rt = F.col(f"r_{time_col}")
    return j.where((rt >= lt + lower_s) & (rt <= lt + upper_s)).drop("__b")


def connect_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Keyed connect of two inputs = unbounded symmetric inner join: every
    arrival meets all earlier rows of the other side with the same key, so
    the final output is the inner equi-join."""
    return left.join(right, left[left_key] == right[right_key], "inner")


def static_threshold_alerts(data: DataFrame, config: DataFrame) -> DataFrame:
    """Broadcast config, static form: the newest threshold (null -> 0) as a
    one-row side.  Only its single value crosses the network."""
    newest = config.agg(F.max_by("threshold", "seq").alias("threshold"))
    # scalar subquery: evaluated once, its single value is shipped to every task
    threshold = F.coalesce(newest.scalar(), F.lit(0))
    return data.withColumn("threshold", threshold).where(F.col("vc") > F.col("threshold"))


def asof_threshold_alerts(data: DataFrame, config: DataFrame, order: str = "seq",
                          scan: Callable = running) -> DataFrame:
    """Broadcast config, dynamic form: each data row is checked against the
    newest threshold that arrived before it (none -> 0).  Both streams are
    merged in arrival order and the latest threshold is carried forward by
    the skew-proof running scan, so the config log may be as large as the
    data."""
    d = data.withColumn("__cfg", F.lit(None).cast("int")).withColumn("__is_cfg", F.lit(False))
    c = config.select(F.col(order), F.col("threshold").alias("__cfg"), *dealt(config))
    for col in data.columns:
        if col not in c.columns:
            c = c.withColumn(col, F.lit(None).cast(data.schema[col].dataType))
    c = c.withColumn("__is_cfg", F.lit(True)).select(*d.columns)
    merged = d.unionByName(c)
    r = scan(merged, [], [order], [Agg("threshold", "last", "__cfg")])
    out = r.where(~F.col("__is_cfg")).withColumn("threshold", F.coalesce(F.col("threshold"), F.lit(0)))
    return out.where(F.col("vc") > F.col("threshold")).drop("__cfg", "__is_cfg")


def lateral_split(df: DataFrame, line_col: str, outer: bool = False) -> DataFrame:
    """``FROM t, LATERAL TABLE(split(line))`` (inner) or ``LEFT JOIN LATERAL
    ... ON TRUE`` (outer: a line without words keeps one row of nulls)."""
    words = java_split(F.col(line_col), " ")
    rows = df.select("*", (F.explode_outer(words) if outer else F.explode(words)).alias("word"))
    return rows.withColumn("length", F.length("word").cast("int"))
