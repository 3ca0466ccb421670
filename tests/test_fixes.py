"""Rows and values that must not get lost: null order, carriage returns, surrogate pairs, carried states."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.functions.scalar import java_hash, java_string_hash
from sensorflow.operators.scan import Agg, end_states, running
from sensorflow.session import scratch_path
from sensorflow.sinks import console
from sensorflow.sources import files, generators
from sensorflow.streaming import harness as H


def test_rows_without_a_place_are_replayed(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (9, "d")], "seq bigint, id string")

    def start(src, run):
        return H.append_sink(src, run, "null_order_test")
    run = H.replay(spark, "null_order", df, "seq", 3, start, flush=False)
    assert sorted(r.id for r in H.read_append(spark, run).collect()) == ["a", "b", "c", "d"]


def test_carriage_returns_stay_inside_lines(spark):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([("a\rb c",), ("d",)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    assert sorted(r.value for r in files.text_file(spark, path).collect()) == ["a\rb c", "d"]
    df = spark.createDataFrame([(1, "a\rb c"), (2, "d")], "seq bigint, value string")

    def start(src, run):
        return H.append_sink(src, run, "cr_test")
    run = H.replay(spark, "cr", df, "seq", 2, start, fmt="text", text_col="value", flush=False)
    assert sorted(r.value for r in spark.read.parquet(run.sink).collect()) == ["a\rb c", "d"]


def test_string_hash_counts_utf16_units(spark):
    def java(s):
        h = 0
        raw = s.encode("utf-16-be", "surrogatepass")
        for i in range(0, len(raw), 2):
            h = (31 * h + int.from_bytes(raw[i:i + 2], "big")) & 0xFFFFFFFF
        return h - (1 << 32) if h >> 31 else h
    words = ["", "s1", "é", "\U0001F600", "a\U0001F600b", "漢字" * 20]
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", java_string_hash("w").alias("h")).collect()
    assert {r.w: r.h for r in got} == {w: java(w) for w in words}
    assert java("\U0001F600") == 1772899
    assert spark.range(1).select(java_hash(F.lit(True), T.BooleanType())).first()[0] == 1231


def test_scan_goes_on_from_states_of_earlier_rows(spark):
    df = spark.range(300).selectExpr("id AS seq", "id % 4 AS k", "(id * 37) % 101 AS v")
    aggs = [Agg("s", "sum", "v"), Agg("l", "last", "v", exclusive=True), Agg("x", "max_by", "seq", by="v"), Agg("t", "topk", "v", k=3)]
    whole = {r.seq: r for r in running(df, ["k"], ["seq"], aggs).collect()}
    before, got = None, {}
    for lo in (0, 90, 210):
        part = df.where(f"seq >= {lo} AND seq < {dict([(0, 90), (90, 210), (210, 300)])[lo]}")
        got |= {r.seq: r for r in running(part, ["k"], ["seq"], aggs, buckets=5, initial=before).collect()}
        path = scratch_path(spark, "states")
        end_states(part, ["k"], ["seq"], aggs, buckets=5, initial=before).write.parquet(path)
        before = spark.read.parquet(path)
    assert got == whole


def test_a_generator_without_an_end_needs_a_row_count(spark):
    with pytest.raises(ValueError):
        generators.datagen(spark, {"a": ("random", 1, 10)})
    assert generators.datagen(spark, {"a": ("sequence", 1, 7), "b": ("sequence", 1, 9)}).count() == 7


def test_print_sink_can_use_the_error_stream(spark, capsys):
    root = scratch_path(spark, "print")
    spark.range(3).write.parquet(os.path.join(root, "in"))
    src = spark.readStream.schema("id bigint").parquet(os.path.join(root, "in"))
    q = console.print_stream(src, "warn", os.path.join(root, "ck"), to_stderr=True, trigger={"availableNow": True})
    q.awaitTermination()
    err = capsys.readouterr().err
    assert all(f"warn {i}" in err for i in range(3))


def test_lifecycle_opens_and_closes_once_per_task(spark, tmp_path):
    from sensorflow.operators.transforms import map_with_lifecycle
    folder = str(tmp_path)

    def opened(part):
        f = open(os.path.join(folder, f"{part}.log"), "a")
        f.write("open\n")
        return f

    def body(pdf, f):
        f.write("batch\n")
        return pdf

    def closed(f):
        f.write("close\n")
        f.close()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        assert map_with_lifecycle(spark.range(0, 60, 1, 2), body, "id bigint", opened, closed).count() == 60
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    logs = [open(os.path.join(folder, n)).read().split() for n in os.listdir(folder)]
    assert len(logs) == 2
    for log in logs:
        assert log[0] == "open" and log[-1] == "close" and log.count("open") == log.count("close") == 1 and log.count("batch") >= 3


def test_a_late_row_deletes_the_pending_timer(spark):
    """Two rows of a key in two micro-batches: the first one's timer is deleted, one timer fires."""
    from sensorflow.streaming.processors import ProcessingTimeTimer
    import time
    root = scratch_path(spark, "timer")
    src_dir, out = os.path.join(root, "src"), os.path.join(root, "out")
    spark.createDataFrame([(1, "s1")], "seq bigint, id string").write.parquet(src_dir)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", H.ROCKSDB)
    src = spark.readStream.schema("seq bigint, id string").parquet(src_dir)
    res = src.groupBy("id").transformWithStateInPandas(
        statefulProcessor=ProcessingTimeTimer(delay_ms=25_000), outputMode="Append", timeMode="ProcessingTime",
        outputStructType="id string, timer_ms bigint, fired_at_ms bigint")
    q = (res.writeStream.format("parquet").option("path", out).option("checkpointLocation", os.path.join(root, "ck"))
         .trigger(processingTime="1 second").start())
    try:
        def waits(n, seconds):
            end = time.time() + seconds
            while time.time() < end and sum(p["numInputRows"] for p in q.recentProgress) < n:
                time.sleep(0.5)
        waits(1, 60)
        spark.createDataFrame([(2, "s1")], "seq bigint, id string").write.mode("append").parquet(src_dir)
        waits(2, 60)
        end = time.time() + 90
        rows = []
        while time.time() < end and not rows:
            time.sleep(1)
            try:
                rows = spark.read.schema("id string, timer_ms bigint, fired_at_ms bigint").parquet(out).collect()
            except Exception:  # nothing written yet
                rows = []
        assert len(rows) == 1 and rows[0].id == "s1"
        time.sleep(5)
        assert spark.read.parquet(out).count() == 1
    finally:
        q.stop()
        if before is not None:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
