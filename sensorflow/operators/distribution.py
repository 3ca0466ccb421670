"""User-level physical distribution (who processes which row)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_key(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """Same key -> same partition (hash exchange)."""
    return df.repartition(n, *keys)


def random_shuffle(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    return df.repartition(n, F.rand(seed))


def round_robin(df: DataFrame, n: int) -> DataFrame:
    """Even spread regardless of key; repairs source skew."""
    return df.repartition(n)


def rescale(df: DataFrame, n: int) -> DataFrame:
    """Merge neighbouring partitions without a shuffle."""
    return df.coalesce(n)


def replicate(df: DataFrame, n: int, col: str = "replica") -> DataFrame:
    """Every row to every one of ``n`` partitions (row i of replica r lands in partition r)."""
    rep = df.withColumn(col, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return rep.repartitionById(n, F.col(col)) if hasattr(rep, "repartitionById") \
        else rep.repartition(n, F.col(col))


def custom(df: DataFrame, n: int, key: Column) -> DataFrame:
    """User partitioner: ``int(key) % n`` decides the partition directly
    (Java ``%``: a negative key gives a negative id and fails, as there)."""
    pid = (key.cast("int") % F.lit(n))
    if hasattr(df, "repartitionById"):
        return df.repartitionById(n, pid)
    raise RuntimeError("repartitionById needs Spark 4.1+")
