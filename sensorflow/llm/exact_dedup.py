"""Exact dedup by content sort.

Sampled splitters range-partition the rows by their normalised bytes, an
external sort inside each partition places equal texts next to each other, and
neighbours are compared in full.  The order is (first bytes, 64-bit hash, all
bytes, rank of the row), so equal texts are adjacent, what the splitters carry
to the driver stays small, and a group that holds a third of all rows is cut at
its rows' ranks into as many partitions as its size asks for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorflow.llm.common import SPACE_CHARS, stored, table, text_or_empty

# Bytes of the text that lead the sort key; equal keys beyond them are told apart by hash and full bytes.
LEAD_BYTES = 24

PIECES = ("doc_id bigint, keep_id bigint, keep_chars bigint, group_size bigint, text_sha256 string, "
          "piece string, head boolean, norm binary")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of equal neighbours in one sorted partition.

    A group that cannot reach over the partition's edge leaves finished.  A group
    whose key (lead, hash) is that of the first or of the last row may go on in
    another partition: its rows carry a piece name, its head row also the bytes.
    """
    from pyspark import TaskContext

    pid = TaskContext.get().partitionId()
    schema = pa.schema([("doc_id", pa.int64()), ("keep_id", pa.int64()), ("keep_chars", pa.int64()),
                        ("group_size", pa.int64()), ("text_sha256", pa.string()), ("piece", pa.string()),
                        ("head", pa.bool_()), ("norm", pa.binary())])
    first_key = None
    held: list[dict] = []  # groups of the current key: small columns only, and one text each
    serial = 0

    def flush(groups: list[dict], edge: bool) -> pa.RecordBatch | None:
        nonlocal serial
        cols: dict[str, list] = {n: [] for n in schema.names}
        for g in groups:
            n = sum(map(len, g["ids"]))
            name = f"{pid}-{serial}" if edge else None
            serial += 1
            cols["doc_id"] += g["ids"]
            cols["keep_id"].append(pa.repeat(g["ids"][0][0], n))
            cols["keep_chars"].append(pa.repeat(pa.scalar(g["chars"], pa.int64()), n))
            cols["group_size"].append(pa.repeat(pa.scalar(n, pa.int64()), n))
            cols["text_sha256"] += [g["sha"]] * n
            cols["piece"] += [name] * n
            cols["head"] += [True] + [False] * (n - 1)
            cols["norm"] += [g["norm"] if edge else None] + [None] * (n - 1)
        if not cols["doc_id"]:
            return None
        arrays = [pa.concat_arrays(cols[f.name]) if f.type == pa.int64() else pa.array(cols[f.name], f.type)
                  for f in schema]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    for b in batches:
        if not b.num_rows:
            continue
        norm, chars = b.column(0), b.column(1).to_numpy()
        ids = b.column(2)
        lead, h = b.column(3), b.column(4).to_numpy()
        n = b.num_rows
        new = np.ones(n, bool)
        if n > 1:
            new[1:] = ~pc.equal(norm.slice(1), norm.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], n)
        done: list[dict] = []
        for s, e in zip(starts.tolist(), ends.tolist()):
            key = (lead[s].as_py(), int(h[s]))
            raw = norm[s].as_py()
            if s == 0 and held and held[-1]["key"] == key and held[-1]["norm"] == raw:
                held[-1]["ids"].append(ids.slice(s, e - s))
                continue
            if first_key is None:
                first_key = key
            if held and held[-1]["key"] != key:
                if held[0]["key"] == first_key:
                    out = flush(held, True)
                    if out is not None:
                        yield out
                else:
                    done += held
                held = []
            held.append({"key": key, "norm": raw, "sha": hashlib.sha256(raw).hexdigest(),
                         "chars": int(chars[s]), "ids": [ids.slice(s, e - s)]})
        out = flush(done, False)
        if out is not None:
            yield out
    out = flush(held, True)
    if out is not None:
        yield out


def dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without the characters of ``[\\x20\\x09-\\x0D]``;
    null counts as empty.  Of equal texts the row with the most code points, then
    the smallest doc_id, stays (a null doc_id comes last).  Exactly one row of a
    group is kept, also where whole rows are repeated.  An empty table gives no
    rows; other columns are ignored.
    """
    spark = docs.sparkSession
    text = text_or_empty()
    norm = F.translate(text, SPACE_CHARS, "").cast("binary")
    rows = (docs.select(norm.alias("norm"), F.char_length(text).cast("bigint").alias("chars"),
                        F.col("doc_id").cast("bigint").alias("doc_id"))
            .withColumn("lead", F.substring("norm", 1, LEAD_BYTES))
            .withColumn("h", F.xxhash64("norm")))
    rank = [F.col("chars").desc(), F.col("doc_id").asc_nulls_last()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (rows.repartitionByRange(parts, F.col("lead"), F.col("h"), *rank)
             .sortWithinPartitions("lead", "h", "norm", *rank))
    pieces = stored(dealt.mapInArrow(_pieces, PIECES), "content_sort")
    # heads of groups at partition edges: a few per partition, merged on their full bytes
    heads = pieces.where("head and piece is not null")
    best = F.min(F.struct((-F.col("keep_chars")).alias("c"), F.col("keep_id").isNull().alias("n"), "keep_id", "piece"))
    whole = heads.groupBy("norm").agg(best.alias("best"), F.sum("group_size").alias("total"),
                                      F.collect_list("piece").alias("pieces"))
    whole = whole.select(F.explode("pieces").alias("piece"), F.col("best.keep_id").alias("whole_id"),
                         F.col("best.piece").alias("best_piece"), "total")
    # bounded: the groups that share a key with the first or last row of a partition
    joined = pieces.join(F.broadcast(whole), "piece", "left")
    merged = F.col("total").isNotNull()
    return joined.select("doc_id", F.when(merged, F.col("whole_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                         F.coalesce("total", "group_size").cast("bigint").alias("group_size"),
                         (F.col("head") & (~merged | (F.col("piece") == F.col("best_piece")))).alias("kept"),
                         "text_sha256")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, columns as they are: one for each distinct normalised text."""
    def key(digest, doc_id):
        return F.concat_ws("/", digest, F.coalesce(doc_id.cast("string"), F.lit("none")))

    kept = dedup(docs).where("kept").select(key(F.col("text_sha256"), F.col("doc_id")).alias("key"))
    norm = F.translate(text_or_empty(), SPACE_CHARS, "")
    rows = docs.select(F.struct("*").alias("row"), F.char_length(text_or_empty()).alias("chars"),
                       key(F.sha2(norm, 256), F.col("doc_id").cast("bigint")).alias("key"))
    # a text that stays is there once, unless its row is repeated under one id
    first = Window.partitionBy("key").orderBy(F.desc("chars"))
    return (rows.join(kept, "key", "left_semi").withColumn("nth", F.row_number().over(first))
            .where("nth = 1").select("row.*"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
     w AS (SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id) AS keep_id,
                  count(*) OVER (PARTITION BY norm) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM w
"""


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the document that stays of its group of equal texts."""
    return dedup(table(spark, sf_dir, "documents"))
