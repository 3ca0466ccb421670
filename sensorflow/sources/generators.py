"""Generated sources: literal rows, number sequences, declarative generators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def from_elements(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """Literal rows (a driver-side collection: for small fixed inputs only)."""
    return spark.createDataFrame(rows, schema)


def sequence(spark: SparkSession, n: int, parallelism: int = 2, prefix: str = "Number:") -> DataFrame:
    """Numbers 0..n-1 mapped to ``prefix + i``; each task owns one contiguous
    range (0..n/p-1, n/p..), generated on the executors."""
    return spark.range(0, n, 1, parallelism).select(
        F.col("id").alias("i"), F.concat(F.lit(prefix), F.col("id").cast("string")).alias("value"))


def sequence_stream(spark: SparkSession, rows_per_second: int = 10, parallelism: int = 2,
                    prefix: str = "Number:") -> DataFrame:
    """Rate-limited unbounded form (``rate`` source: value 0, 1, 2, ...)."""
    raw = (spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
           .option("numPartitions", parallelism).load())
    return raw.select(F.col("value").alias("i"), F.concat(F.lit(prefix), F.col("value").cast("string")).alias("value"),
                      "timestamp")


def _field(kind: str, idx, seed: int, lo: int, hi: int):
    if kind == "sequence":
        return (F.lit(lo) + idx).cast("bigint")
    if kind == "random":
        return F.floor(F.rand(seed) * (hi - lo + 1) + lo).cast("bigint")
    raise ValueError(kind)


def datagen(spark: SparkSession, spec: dict[str, tuple], rows: int | None = None, seed: int = 42,
            parallelism: int = 2) -> DataFrame:
    """Declarative generator: ``{'id': ('random', 1, 10), 'ts': ('sequence', 1, 1000000)}``.
    ``rows`` defaults to the length of the shortest sequence field, which ends
    the source; without such a field it must be given."""
    seqs = [hi - lo + 1 for kind, lo, hi, *_ in spec.values() if kind == "sequence"]
    if rows is None and not seqs:
        raise ValueError("give rows: no sequence field bounds the generator")
    n = rows if rows is not None else min(seqs)
    base = spark.range(0, n, 1, parallelism)
    cols = [_field(kind, F.col("id"), seed + i, lo, hi).cast(rest[0] if rest else "bigint").alias(name)
            for i, (name, (kind, lo, hi, *rest)) in enumerate(spec.items())]
    return base.select(*cols)


def datagen_stream(spark: SparkSession, spec: dict[str, tuple], rows_per_second: int = 1, seed: int = 42) -> DataFrame:
    """Streaming generator on the ``rate`` source.  Sequence fields follow the rate value; the
    shortest one ends the rows."""
    raw = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    ends = [hi - lo + 1 for kind, lo, hi, *_ in spec.values() if kind == "sequence"]
    if ends:
        raw = raw.where(F.col("value") < min(ends))
    cols = [_field(kind, F.col("value"), seed + i, lo, hi).cast(rest[0] if rest else "bigint").alias(name)
            for i, (name, (kind, lo, hi, *rest)) in enumerate(spec.items())]
    return raw.select(*cols)
