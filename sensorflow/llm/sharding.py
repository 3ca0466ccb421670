"""Sharding by jump consistent hashing (law ``key``).

The shard of a row follows from its key and the shard count alone: no ring
table, and going from n to n + 1 shards moves rows only into the new shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorflow.llm.common import stored, table, text_or_empty

# Fixed values of the published jump hash: its 64-bit linear congruential step.
LCG_MULTIPLIER = np.uint64(2862933555777941757)
LCG_SHIFT = np.uint64(33)
SHARDS = 16
# Slots are numbered per (shard, lane) and shifted by the lanes before: no task holds a whole shard.
LANES = 1024


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each uint64 key, all keys advanced together until every one has landed."""
    state = keys.astype(np.uint64)
    landed = np.zeros(len(state), np.int64)
    todo = np.arange(len(state))
    while len(todo):
        state[todo] = state[todo] * LCG_MULTIPLIER + np.uint64(1)
        span = (state[todo] >> LCG_SHIFT).astype(np.float64) + 1.0
        jump = (landed[todo] + 1) * (float(1 << 31) / span)
        inside = jump < shards
        todo = todo[inside]
        landed[todo] = jump[inside].astype(np.int64)
    return landed


def with_shards(df: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    """Adds ``name``: the jump-hash shard of the column ``key`` (any hashable type; null is one key)."""
    if shards < 1:
        raise ValueError("shards must be at least 1")

    @F.pandas_udf("int")
    def landed(h: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(h.to_numpy().view(np.uint64), shards), dtype="int32")

    return df.withColumn(name, landed(F.xxhash64(key)))


def assign(docs: DataFrame, shards: int = SHARDS, lanes: int = LANES) -> DataFrame:
    """One row per row of ``docs``: shard, gapless slot in it, and the shard under one more shard.

    Size is the UTF-8 length of the text plus 1; a null text counts as empty in
    size and crc32.  The law is ``key``: equal texts under different ids may part.
    Slots follow (lane, doc_id, crc32, size); fully equal rows get the slots of
    their ties in any order.  An empty table gives no rows.  Columns besides
    doc_id and text are ignored, whatever their names.
    """
    text = text_or_empty()
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"),
                       F.crc32(text).cast("bigint").alias("text_crc32"))
    rows = with_shards(with_shards(rows, "doc_id", shards), "doc_id", shards + 1, "grown_shard")
    rows = stored(rows.withColumn("lane", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(lanes)).cast("int")),
                  "shards")
    # at most shards * lanes rows, whatever the input
    before = Window.partitionBy("shard").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("shard", "lane").agg(F.count("*").alias("n"))
               .select("shard", "lane", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    inside = Window.partitionBy("shard", "lane").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("rank", F.row_number().over(inside))
            .join(F.broadcast(offsets), ["shard", "lane"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("offset") + F.col("rank") - 1).cast("bigint").alias("slot"), "grown_shard"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt to shards 0 to 15 by jump consistent hashing of doc_id."""
    return assign(table(spark, sf_dir, "documents"))
