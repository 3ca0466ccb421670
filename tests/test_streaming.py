"""Streaming behaviour: stream/batch parity for operators that are only
pytest-checked, TTL state, multi-input watermark rule."""

import os

from pyspark.sql import functions as F

from conftest import sensor_df
from sensorflow.operators import eventtime, state, windows
from sensorflow.session import scratch_path
from sensorflow.sources.tables import arrivals
from sensorflow.streaming import harness as H
from sensorflow.streaming.processors import TTL_OUT, TtlLastValue

SF = "/root/testdata/sf0.001"


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_dynamic_gap_session_stream_matches_batch(spark):
    data = arrivals(spark, SF).select("seq", "id", "ts", "vc", "t", "arrival")
    gap = F.concat(((F.col("vc") + 1) * 60).cast("string"), F.lit(" seconds"))

    def start(src, run):
        g = (src.withWatermark("t", "1800 seconds")
             .groupBy(F.session_window("t", gap).alias("w"), "id").agg(*windows.default_aggs()))
        return H.append_sink(windows.with_bounds(g), run, "dyn_session_test")
    run = H.replay(spark, "dyn_session_test", data, "arrival", 3, start)
    got = H.read_append(spark, run).select("id", "win_start", "win_end", "cnt", "vc_sum")
    batch = windows.sessions(data.select("seq", "id", "ts", "vc"), ["id"],
                             gap_col=(F.col("vc").cast("bigint") + 1) * 60)
    assert _sorted(got) == _sorted(batch.select("id", "win_start", "win_end", "cnt", "vc_sum"))


def test_ttl_state_processing_time(spark):
    """TWS value state with a TTL long enough that nothing expires during the
    test equals the event-time twin with an infinite TTL."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", H.ROCKSDB)
    df = sensor_df(spark, [("s1", 1, 11), ("s1", 2, 5), ("s1", 3, 30), ("s2", 4, 3), ("s2", 5, 12)])
    root = scratch_path(spark, "ttl-test")
    df.select("seq", "id", "ts", "vc").write.parquet(os.path.join(root, "src"))
    src = spark.readStream.schema("seq bigint, id string, ts bigint, vc int").parquet(os.path.join(root, "src"))
    res = src.groupBy("id").transformWithStateInPandas(
        statefulProcessor=TtlLastValue(ttl_ms=3_600_000, write_above=10), outputStructType=TTL_OUT,
        outputMode="Append", timeMode="ProcessingTime")
    q = (res.writeStream.format("parquet").option("path", os.path.join(root, "out"))
         .option("checkpointLocation", os.path.join(root, "ck")).trigger(availableNow=True).start())
    # processing-time state processors keep scheduling batches: bound the wait, then stop
    q.awaitTermination(20)
    q.stop()
    got = _sorted(spark.read.parquet(os.path.join(root, "out")).select("seq", "state"))
    batch = state.ttl_last_value(df, ttl_s=10 ** 9, write_above=10)
    assert got == _sorted(batch.select("seq", "state"))
    assert got == [(0, None), (1, 11), (2, 11), (3, None), (4, None)]


def test_ttl_event_time_expiry(spark):
    # ttl 5 s: gaps of 3 s keep the value alive (refresh on read), a 6 s gap expires it
    df = sensor_df(spark, [("s1", 0, 20), ("s1", 3, 1), ("s1", 6, 1), ("s1", 12, 1)])
    got = [r[0] for r in state.ttl_last_value(df, 5).orderBy("seq").select("state").collect()]
    assert got == [None, 20, 20, None]


def test_two_input_watermark_is_minimum(spark):
    # left reaches t=100 early, right only t=10: the operator watermark follows the right side
    left = spark.createDataFrame([(0, 100, 0), (2, 50, 2)], "seq bigint, ts bigint, arrival bigint")
    right = spark.createDataFrame([(1, 10, 1), (3, 5, 3)], "seq bigint, ts bigint, arrival bigint")
    out = eventtime.late_rows_two_inputs(left, right, 3, ["arrival", "seq"]).orderBy("seq")
    # watermark before seq 2 = min(100, 10) - 3 s - 1 ms = 6999 ms -> 50 s is on time
    # before seq 3: min(100, 10) -> 6999 ms, 5 s = 5000 ms < 6999 -> late
    assert [r["late"] for r in out.collect()] == [False, False, False, True]


def test_foreach_writer_and_table_stream(spark):
    """SNK-6: a lifecycle writer opens one connection per task and epoch and
    writes every row through it; SNK-7: a stream inserted into a table."""
    from sensorflow.sinks import custom
    from sensorflow.sinks import tables as table_sinks
    root = scratch_path(spark, "sink-test")
    src_dir = os.path.join(root, "src")
    out_dir = os.path.join(root, "out").removeprefix("file:")
    os.makedirs(out_dir, exist_ok=True)
    spark.createDataFrame([(i, f"s{i % 3}") for i in range(20)], "seq bigint, id string").write.parquet(src_dir)
    src = spark.readStream.schema("seq bigint, id string").parquet(src_dir)

    def connect(part, epoch):
        return open(os.path.join(out_dir, f"part-{part}-{epoch}.txt"), "a")

    writer = custom.LifecycleWriter(connect, lambda f, row: f.write(f"{row.seq},{row.id}\n"), lambda f: f.close())
    q = (src.writeStream.foreach(writer).option("checkpointLocation", os.path.join(root, "ck1"))
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    lines = [l for f in os.listdir(out_dir) for l in open(os.path.join(out_dir, f)).read().splitlines()]
    assert sorted(int(l.split(",")[0]) for l in lines) == list(range(20))

    name = "sink_stream_t"
    spark.sql(f"CREATE TABLE {name} (seq bigint, id string) USING parquet LOCATION '{os.path.join(root, 'tbl')}'")
    q2 = table_sinks.start_table_stream(src, name, os.path.join(root, "ck2"), {"availableNow": True})
    q2.awaitTermination(120)
    assert spark.table(name).count() == 20


def test_text_file_source(spark):
    from sensorflow.sources.files import text_file
    root = scratch_path(spark, "text-src")
    spark.createDataFrame([("hello flink",), ("hello world",), ("hello java",)], "value string") \
        .coalesce(1).write.text(root)
    assert sorted(r[0] for r in text_file(spark, root).collect()) == ["hello flink", "hello java", "hello world"]
