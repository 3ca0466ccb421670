"""Record-level operators: parse, map, filter, flat-map, routing, unions.

All of them are narrow (no shuffle) and work unchanged on batch and
streaming DataFrames.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.scalar import java_split

SENSOR_DDL = "id string, ts bigint, vc int"


# ---- SRC-8 / PRJ-2: "id,ts,vc" text -> typed sensor record -----------------

def parse_sensor(lines: DataFrame, col: str = "value", on_error: str = "raise") -> DataFrame:
    """Parse ``id,ts,vc`` lines.  ``on_error='raise'`` fails on a bad number
    (ANSI cast), ``'quarantine'`` keeps the row with ``_bad = true`` and nulls."""
    parts = java_split(F.col(col), ",")
    others = [c for c in lines.columns if c != col]
    if on_error == "raise":
        ts = parts[1].cast("bigint")
        vc = parts[2].cast("int")
        return lines.select(*others, parts[0].alias("id"), ts.alias("ts"), vc.alias("vc"))
    ts = F.expr("try_cast(element_at(__p, 2) as bigint)")
    vc = F.expr("try_cast(element_at(__p, 3) as int)")
    out = (lines.withColumn("__p", parts)
           .select(*others, F.col("__p")[0].alias("id"), ts.alias("ts"), vc.alias("vc"),
                   F.col("__p")[1].alias("_ts_raw"), F.col("__p")[2].alias("_vc_raw")))
    bad = (F.col("ts").isNull() & F.col("_ts_raw").isNotNull()) | \
          (F.col("vc").isNull() & F.col("_vc_raw").isNotNull())
    return out.withColumn("_bad", bad).drop("_ts_raw", "_vc_raw")


# ---- PRJ-1 / PRJ-9 ---------------------------------------------------------

def map_project(df: DataFrame, *cols: str | Column) -> DataFrame:
    return df.select(*cols)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(mapping.get(c, c)) for c in df.columns])


# ---- PRJ-3 -----------------------------------------------------------------

def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    """Parameterised equality filter; a null column never matches."""
    return df.where(F.col(col) == F.lit(value))


# ---- PRJ-4: 1 -> 0/1/2 conditional flat-map --------------------------------

def flatmap_conditional(df: DataFrame) -> DataFrame:
    """s1 -> [vc]; s2 -> [ts, vc]; any other id -> nothing (values as strings)."""
    out = (F.when(F.col("id") == "s1", F.array(F.col("vc").cast("string")))
           .when(F.col("id") == "s2", F.array(F.col("ts").cast("string"), F.col("vc").cast("string")))
           .otherwise(F.array().cast("array<string>")))
    others = [c for c in df.columns if c not in ("t",)]
    return df.select(*others, F.posexplode(out).alias("pos", "value"))


# ---- PRJ-6: map with per-task set-up / tear-down ---------------------------

def map_with_lifecycle(df: DataFrame, fn: Callable[[pd.DataFrame, object], pd.DataFrame], schema: str,
                       open_fn: Callable[[int], object] | None = None,
                       close_fn: Callable[[object], None] | None = None) -> DataFrame:
    """Rich-function style map: ``open_fn(partition)`` runs once per task
    before the first batch, ``close_fn`` once after the last (also on error),
    ``fn(batch, what open_fn gave)`` on every Arrow batch in between."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        resource = open_fn(part) if open_fn else None
        try:
            for pdf in batches:
                yield fn(pdf, resource)
        finally:
            if close_fn:
                close_fn(resource)

    return df.mapInPandas(run, schema)


def parse_int_plus_one(df: DataFrame, col: str = "value") -> DataFrame:
    """The lifecycle demo's body: ``Integer.parseInt(value) + 1`` per record."""
    keep = [c for c in df.columns if c != col]

    def parser(part: int) -> Callable[[pd.Series], pd.Series]:
        return lambda texts: pd.to_numeric(texts, errors="raise").astype("int64")

    def body(pdf: pd.DataFrame, parse: Callable[[pd.Series], pd.Series]) -> pd.DataFrame:
        out = pdf[keep].copy()
        out["result"] = parse(pdf[col]) + 1
        return out

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields if f.name != col)
    schema = (fields + ", " if fields else "") + "result bigint"
    return map_with_lifecycle(df, body, schema, parser)


# ---- SPL-1 / SPL-2 / SPL-3 -------------------------------------------------

def split_by_filters(df: DataFrame, predicates: dict[str, Column]) -> dict[str, DataFrame]:
    """One filter per output (the source is read once per output)."""
    return {name: df.where(p) for name, p in predicates.items()}


def route(df: DataFrame, routes: dict[str, Column], default: str = "main",
          col: str = "route") -> DataFrame:
    """One-pass routing: tag each row with the first matching route."""
    expr = None
    for name, pred in routes.items():
        expr = F.when(pred, F.lit(name)) if expr is None else expr.when(pred, F.lit(name))
    expr = F.lit(default) if expr is None else expr.otherwise(F.lit(default))
    return df.withColumn(col, expr)


def routes(df: DataFrame, routes_: dict[str, Column], default: str = "main") -> dict[str, DataFrame]:
    """Side outputs as separate DataFrames over one tagged scan.  Persist the
    tagged frame (or use ``foreachBatch`` on streams) when several are written."""
    tagged = route(df, routes_, default)
    names = list(routes_) + [default]
    return {n: tagged.where(F.col("route") == n).drop("route") for n in names}


def alert_side_output(df: DataFrame, threshold: int = 10) -> tuple[DataFrame, DataFrame]:
    """Main output keeps every row; side output holds an alert message for
    every row with vc > threshold."""
    alerts = df.where(F.col("vc") > threshold).select(
        *[c for c in df.columns if c != "t"],
        F.concat(F.lit("level "), F.col("vc").cast("string"), F.lit(f" is above {threshold}")).alias("message"))
    return df, alerts


# ---- SET-1 / SET-2 ---------------------------------------------------------

def union_all(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def connect_map(left: DataFrame, right: DataFrame, left_map: Column, right_map: Column,
                name: str = "value") -> DataFrame:
    """Two differently typed inputs, each mapped to a common type, then merged."""
    return union_all(left.select(F.lit("left").alias("side"), left_map.alias(name)),
                     right.select(F.lit("right").alias("side"), right_map.alias(name)))
