"""Streams scan in the ranges they were staged in, keep live states only and look at few rows twice."""

from pyspark.sql import functions as F

from sensorflow.operators import scan, windows
from sensorflow.operators.scan import BUCKET, Agg
from sensorflow.session import scratch_path
from sensorflow.streaming import catalog as C
from sensorflow.streaming import harness as H
from sensorflow.streaming import states
from tests.test_states import events

AGGS = [Agg("s", "sum", "vc"), Agg("f", "first", "vc"), Agg("l", "last", "vc", exclusive=True), Agg("t", "topk", "vc", k=2)]


def sensors(spark, n):
    return spark.createDataFrame([(i, f"k{i % 5}" if i % 7 else None, (i * 37) % 101 if i % 6 else None) for i in range(n)],
                                 "seq bigint, id string, vc int")


def test_staged_rows_come_with_the_buckets_of_their_order(spark, monkeypatch):
    monkeypatch.setattr(H, "BUCKET_ROWS", 10)
    df = spark.range(400).select((F.col("id") / 2).cast("bigint").alias("seq"))
    path = scratch_path(spark, "ranges")
    assert H.stage(df, "seq", 2, path, ranges=True) == 2
    rows = spark.read.parquet(path).orderBy("seq").collect()
    assert len(rows) == 400 and [r[BUCKET] for r in rows] == sorted(r[BUCKET] for r in rows)
    assert len({r[BUCKET] for r in rows}) > 12 and all(r[BUCKET] // 12 == r[H.BATCH] for r in rows)
    assert len({(r.seq, r[BUCKET]) for r in rows}) == 200
    monkeypatch.setattr(H, "BUCKET_ROWS", 1000)
    H.stage(df, "seq", 2, path := scratch_path(spark, "ranges"), ranges=True)
    assert {r[BUCKET] for r in spark.read.parquet(path).select(BUCKET).distinct().collect()} == {0, 12}


def test_a_scan_of_staged_rows_looks_for_no_cuts(spark):
    df = sensors(spark, 200).withColumn(BUCKET, F.floor(F.col("seq") / 30).cast("int"))
    out = scan.running(df, ["id"], ["seq"], AGGS)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and BUCKET not in out.columns
    want = scan.running(df.drop(BUCKET), ["id"], ["seq"], AGGS)
    assert sorted(map(repr, out.collect())) == sorted(map(repr, want.collect()))


def test_both_steps_of_a_batch_go_by_the_states_of_its_buckets(spark):
    df = sensors(spark, 300).withColumn(BUCKET, F.floor(F.col("seq") / 30).cast("int"))
    whole = sorted(map(repr, scan.running(df.drop(BUCKET), ["id"], ["seq"], AGGS).collect()))
    path, got, made = scratch_path(spark, "scan"), [], []
    for b in range(3):
        held = []
        step = C.state_scan(spark, path, b, held=held)
        got += map(repr, step(df.where(F.floor(F.col("seq") / 100) == b), ["id"], ["seq"], AGGS).collect())
        made.append(len(held))
        for x in held:
            x.unpersist()
    assert sorted(got) == whole and made == [1, 2, 2]


def test_count_windows_that_wait_are_told_by_their_counts(spark):
    places = windows.tumbling_places(sensors(spark, 60).withColumn("ts", F.col("seq")), 5, ["id"], ["seq"])
    counts = windows.counted(places, ["id"], "window_no")
    full = F.col("cnt") == 5
    assert counts.where(~full).count() > 0
    assert sorted(map(repr, counts.where(full).drop("__last_rn").collect())) == sorted(map(repr, windows.fired(places, ["id"], "window_no", full).collect()))


def test_destroyed_windows_are_not_kept(spark, monkeypatch):
    """All windows of a batch but those still open at its end go without a state."""
    path = events(spark, scratch_path(spark, "late"), [(i, 1_700_000_000 + 400 * i, i % 3, "view", float(i % 50)) for i in range(400)])
    written, write = [], states.KeyedLog.write

    def noted(self, batch, changed, gone=None):
        written.append(changed.count())
        write(self, batch, changed, gone)
    monkeypatch.setattr(states.KeyedLog, "write", noted)
    rows = C.STREAM_QUERIES["late_allowed_stream"](spark, path).collect()
    assert len(rows) > 100 and sum(r.cnt for r in rows) > 300
    assert sum(written) < len(rows) / 2
