"""Row files with names and limits, idle inputs, periodic watermarks, any-typed hash, stream generators, a changed plan."""

import os
import time

import pytest
from pyspark.sql import functions as F

from sensorflow.functions import udfs
from sensorflow.functions.scalar import java_hash
from sensorflow.operators import eventtime
from sensorflow.session import path_exists, scratch_path
from sensorflow.sinks import files
from sensorflow.sources import generators
from sensorflow.streaming import harness as H


def test_row_files_roll_by_bytes_and_time(spark):
    """20 bytes a line, 50 a file; a file ends at the line that passes the limit, and at every quarter of an hour."""
    df = spark.createDataFrame([(i, "s" * 8, 3600 + 60 * i, 10) for i in range(40)], "seq bigint, id string, ts bigint, vc int")
    lines = files.rolled_lines(df, files.Rolling("log", ".txt", max_bytes=50, every_s=900), line=F.rpad(F.col("seq").cast("string"), 19, "x"))
    path = files.write_rolled_text(lines, scratch_path(spark, "rolled"))
    got = {r.file: (r.cnt, r.n_bytes) for r in files.read_rolled_files(spark, path).collect()}
    assert got["log-0-0.txt"] == (3, 60) and got["log-0-1.txt"] == (2, 40) and sum(c for c, _ in got.values()) == 40
    assert {n.split("-")[1] for n in got} == {"0", "1", "2"} and not path_exists(spark, f"{path}/_staging")
    # the same rows again give the same files
    files.write_rolled_text(lines, path)
    assert {r.file: (r.cnt, r.n_bytes) for r in files.read_rolled_files(spark, path).collect()} == got
    none = files.write_rolled_text(lines.limit(0), scratch_path(spark, "rolled"))
    assert not path_exists(spark, f"{none}/_staging")


def test_files_in_staging_are_not_read(spark):
    df = spark.createDataFrame([(0, "a", 0, 1)], "seq bigint, id string, ts bigint, vc int")
    path = files.write_rolled_text(files.rolled_lines(df, files.Rolling()), scratch_path(spark, "rolled"))
    df.selectExpr("'half' AS value", "'x' AS bucket", "'y' AS file").write.partitionBy("bucket", "file").text(f"{path}/_staging")
    assert files.read_rolled_files(spark, path).agg(F.sum("cnt")).first()[0] == 1


def test_bucketed_files_are_few(spark):
    """As many files as buckets and write tasks at most, not one for every salt of every hour."""
    df = spark.range(4000).selectExpr("id AS seq", "'s1' AS id", "id * 90 AS ts", "1 AS vc", "timestamp_seconds(id * 90) AS t")
    path = files.write_bucketed_text(df, spark)
    n = len(spark.read.text(path).inputFiles())
    assert 100 <= n <= 100 + int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_an_idle_input_does_not_hold_the_watermark_back(spark):
    rows = [(0, 0, 100, "a"), (1, 1, 10, "b"), (2, 5, 200, "a"), (3, 30, 300, "a"), (4, 31, 310, "a"), (5, 32, 20, "b"), (6, 33, 400, "a")]
    df = spark.createDataFrame(rows, "seq bigint, arrival bigint, ts bigint, src string")
    r = eventtime.idle_watermark(df, 0, 10, "src", ["a", "b"], ["arrival", "seq"]).orderBy("seq").collect()
    lo = eventtime.LONG_MIN
    # none yet, none yet (b has no row), min(100, 10); at 30 both are idle: it stays; at 31 only a counts;
    # b is idle still when its row comes, and back with 20 afterwards: the watermark does not go back
    assert [x.wm_before_ms for x in r] == [lo, lo, 9999, 9999, 299999, 309999, 309999]


def test_periodic_watermark_moves_on_ticks(spark):
    df = spark.createDataFrame([(0, 0, 50), (1, 9, 90), (2, 10, 1), (3, 19, 100), (4, 45, 2), (5, None, 3)], "seq bigint, arrival bigint, ts bigint")
    r = {x.seq: x.wm_before_ms for x in eventtime.periodic_watermark(df, 0, 10).collect()}
    lo = eventtime.LONG_MIN
    assert [r[i] for i in range(5)] == [lo if i < 2 else 89999 if i < 4 else 99999 for i in range(5)] or r[0] in (lo, 2999)
    assert r[4] == 99999 and r[2] == r[3] == 89999


@pytest.mark.parametrize("expr, value", [("'s1'", None), ("CAST(7 AS INT)", 7), ("CAST(-5 AS SMALLINT)", -5), ("CAST(4294967297 AS BIGINT)", 0),
                                         ("true", 1231), ("false", 1237), ("CAST(1.5 AS DOUBLE)", 1073217536), ("CAST(1.5 AS FLOAT)", 1069547520),
                                         ("CAST(NULL AS INT)", None), ("CAST('NaN' AS DOUBLE)", 2146959360), ("CAST(0 AS BIGINT)", 0)])
def test_hash_of_any_type_from_sql(spark, expr, value):
    udfs.register_all(spark)
    got = spark.sql(f"SELECT java_hash(x) AS h FROM (SELECT {expr} AS x FROM range(3))").collect()
    if expr == "'s1'":
        value = 31 * ord("s") + ord("1")
    assert [r.h for r in got] == [value] * 3


def test_hash_from_sql_equals_the_native_form(spark):
    udfs.register_all(spark)
    df = spark.range(-50, 50).selectExpr("id * 123456789123 AS l", "CAST(id AS INT) AS i", "concat('k', id) AS s", "id % 2 = 0 AS b")
    df.createOrReplaceTempView("any_typed")
    for c in df.columns:
        native = [r.h for r in df.select(java_hash(c, df.schema[c].dataType).alias("h")).collect()]
        assert [r.h for r in spark.sql(f"SELECT java_hash({c}) AS h FROM any_typed").collect()] == native


def run_for(spark, df, name, enough, seconds=60):
    """Rows of an unbounded stream until ``enough`` holds."""
    root = scratch_path(spark, name)
    out = os.path.join(root, "out")
    q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", os.path.join(root, "ck"))
         .trigger(processingTime="1 second").start())
    try:
        end = time.time() + seconds
        while time.time() < end:
            rows = spark.read.schema(df.schema).parquet(out).collect() if path_exists(spark, out) else []
            if enough(rows):
                return rows
            time.sleep(1)
    finally:
        q.stop()
    raise AssertionError(f"{name}: too few rows")


def test_sequence_stream(spark):
    rows = run_for(spark, generators.sequence_stream(spark, rows_per_second=20), "sequence", lambda r: len(r) >= 20)
    assert sorted(r.i for r in rows) == list(range(len(rows))) and all(r.value == f"Number:{r.i}" for r in rows)


def test_datagen_stream_ends_with_its_sequence(spark):
    spec = {"id": ("random", 1, 10), "ts": ("sequence", 100, 111), "long": ("sequence", 1, 1000)}
    seen = []

    def enough(rows):
        seen.append(len(rows))
        return len(seen) > 3 and seen[-1] == 12
    rows = run_for(spark, generators.datagen_stream(spark, spec, rows_per_second=10), "datagen", enough)
    assert sorted(r.ts for r in rows) == list(range(100, 112)) and all(1 <= r.id <= 10 for r in rows)


def test_saved_state_is_a_table(spark):
    df = spark.createDataFrame([(i, f"k{i % 3}") for i in range(10)] + [(10, None)], "seq bigint, id string")

    def start(src, run):
        return H.batch_folder_sink(src.groupBy("id").agg(F.count(F.lit(1)).alias("n")), run, "saved")
    run = H.replay(spark, "saved", df, "seq", 2, start, flush=False)
    assert {r.name: r.n for r in H.saved_state(spark, run, "name string", "n bigint").collect()} == {"k0": 4, "k1": 3, "k2": 3, None: 1}
