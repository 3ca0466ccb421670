"""The four user-function families, native first.

* scalar ``java_hash`` (any type)     -> native expression, dispatched on the
                                        column type; SQL name ``java_hash`` takes an
                                        argument of any type (Arrow UDF)
* aggregate weighted average          -> native ``sum/sum``; pandas UDAF for SQL
* table function split -> (word, len) -> native ``inline``; Python UDTF for SQL
* table aggregate Top2               -> ``row_number() <= 2`` (see operators.topn)

The Python-registered versions exist so SQL text can call the functions by
name; queries in this library use the native forms.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.functions.scalar import java_hash


def weighted_avg(score: Column, weight: Column) -> Column:
    """sum(score * weight) / sum(weight) with 64-bit sums (0/0 -> NaN as in Java)."""
    num = F.sum(score.cast("bigint") * weight.cast("bigint")).cast("double")
    den = F.sum(weight.cast("bigint")).cast("double")
    return F.when(den == 0, F.lit(float("nan"))).otherwise(num / den)


@F.pandas_udf(T.DoubleType())
def weighted_avg_udaf(score: pd.Series, weight: pd.Series) -> float:
    den = float(weight.astype("int64").sum())
    num = float((score.astype("int64") * weight.astype("int64")).sum())
    return num / den if den else float("nan")


def _java_string_hash_py(s: str | None) -> int | None:
    if s is None:
        return None
    h = 0
    data = s.encode("utf-16-be")
    for i in range(0, len(data), 2):
        h = (31 * h + ((data[i] << 8) | data[i + 1])) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h


def _folded(bits: np.ndarray) -> np.ndarray:
    """64 bits to 32, as ``Long.hashCode``."""
    bits = bits.view(np.uint64)
    return (bits ^ (bits >> np.uint64(32))).astype(np.uint32).view(np.int32)


@F.arrow_udf(T.IntegerType())
def java_hash_any_udf(x: pa.Array) -> pa.Array:
    """``Object.hashCode`` of an argument of any simple type; null stays null."""
    kind, known = x.type, x.is_valid().to_numpy(zero_copy_only=False)
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return pa.array([_java_string_hash_py(v) for v in x.to_pylist()], pa.int32())
    if pa.types.is_boolean(kind):
        out = np.where(x.fill_null(False).to_numpy(zero_copy_only=False), 1231, 1237).astype(np.int32)
    elif pa.types.is_integer(kind):
        v = x.fill_null(0).to_numpy(zero_copy_only=False)
        out = _folded(v.astype(np.int64)) if kind.bit_width == 64 else v.astype(np.int32)
    elif pa.types.is_float64(kind) or pa.types.is_float32(kind):
        v = x.fill_null(0).to_numpy(zero_copy_only=False).copy()
        v[np.isnan(v)] = np.nan  # one pattern for every NaN
        out = _folded(v.view(np.int64)) if pa.types.is_float64(kind) else v.view(np.int32)
    elif pa.types.is_date32(kind):
        out = _folded(x.cast(pa.int32()).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) * 86_400_000)
    else:
        raise TypeError(f"java_hash: unsupported type {kind}")
    return pa.array(out, pa.int32(), mask=~known)


@F.udtf(returnType="word: string, length: int")
class SplitWords:
    def eval(self, line: str):
        if line is None:
            return
        parts = line.split(" ")
        while len(parts) > 1 and parts[-1] == "":
            parts.pop()
        if parts == [""] and line != "":
            return
        for p in parts:
            yield p, len(p)


def register_all(spark: SparkSession) -> None:
    """Make the functions callable by name from SQL."""
    spark.udf.register("java_hash", java_hash_any_udf)
    spark.udf.register("weighted_avg", weighted_avg_udaf)
    spark.udtf.register("split_words", SplitWords)


def java_hash_any(df, col: str) -> Column:
    """Scalar function over any-typed argument: dispatch on the column type."""
    return java_hash(col, df.schema[col].dataType)
