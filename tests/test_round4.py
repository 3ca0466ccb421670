"""Whole replicas, two scans for any number of triggers, buckets by rows, states without an order, renames in bulk."""

import duckdb
from pyspark.sql import functions as F

from sensorflow.operators import scan, windows
from sensorflow.operators.scan import BUCKET, Agg, end_states, running, with_buckets
from sensorflow.plans import catalog
from sensorflow.session import scratch_path
from sensorflow.sinks import files
from sensorflow.streaming import catalog as C
from tests.test_states import events


def test_replicas_hold_all_sensor_rows(spark):
    """The facts are replicated, not a small dimension."""
    path = events(spark, scratch_path(spark, "replicas"), [(i, 100 * i, i % 3, "view", 1.0) for i in range(37)])
    got = {r.replica: (r.cnt, r.misplaced) for r in catalog.QUERIES["part_replicate"](spark, path).collect()}
    assert got == {i: (37, 0) for i in range(4)}


def test_triggers_share_two_scans(spark):
    """Four triggers take two scans, not six, and fire as each does by itself."""
    df = spark.createDataFrame([(i, f"k{i % 3}" if i % 5 else None, (i * 37) % 101 if i % 7 else None) for i in range(120)],
                               "seq bigint, id string, vc int")
    calls = []

    def counted(*args, **more):
        calls.append(1)
        return running(*args, **more)
    got = sorted(map(repr, windows.triggers_compared(df, 3, 50, scan=counted).collect()))
    assert len(calls) == 2
    kinds = {"count keep": windows.Trigger(every=3), "count purge": windows.Trigger(every=3, purge=True),
             "condition keep": windows.Trigger(when=F.col("vc") > 50), "condition purge": windows.Trigger(when=F.col("vc") > 50, purge=True)}
    want = []
    for n, t in kinds.items():
        want += windows.global_trigger(df, ["id"], t).select(F.lit(n).alias("trigger"), "id", "seq", "firing", "cnt", "vc_sum").collect()
    assert got == sorted(map(repr, want)) and want


def test_buckets_follow_the_rows(spark, monkeypatch):
    """A key of a few rows has one state, not one for every row; a hot key is still spread."""
    few = spark.range(3000).selectExpr("id AS seq", "id % 30 AS k", "id AS v")
    assert with_buckets(few, ["k"], ["seq"]).select(scan.KEY, BUCKET).distinct().count() == 30
    monkeypatch.setattr(scan, "BUCKET_ROWS", 10)
    for rows, most in ((3000, 3000 / 32), (100, 40)):
        hot = spark.range(rows).selectExpr("id AS seq", "0 AS k", "id AS v")
        sizes = [r.n for r in with_buckets(hot, ["k"], ["seq"]).groupBy(BUCKET).agg(F.count("*").alias("n")).collect()]
        assert len(sizes) >= 8 and max(sizes) <= most
        assert running(hot, ["k"], ["seq"], [Agg("s", "sum", "v")]).where("s != seq * (seq + 1) / 2").count() == 0


def test_bucket_expression_is_short(spark):
    """A comparison for each cut made a method too long to be compiled: 28 microseconds a row."""
    df = spark.range(10).selectExpr("id AS seq", "id % 2 AS k", "id AS v")
    plan = with_buckets(df, ["k"], ["seq"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(">=") < 10


def test_end_states_need_no_cuts(spark):
    df = spark.range(200).selectExpr("id AS seq", "id % 4 AS k", "(id * 37) % 101 AS v")
    out = end_states(df, ["k"], ["seq"], [Agg("s", "sum", "v"), Agg("l", "last", "v"), Agg("t", "topk", "v", k=2)])
    assert "percentile" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r[scan.KEY].k: (r["__s0"], r["__s1"].v, r["__t0"]) for r in out.collect()}
    assert got == {k: (sum((i * 37) % 101 for i in range(k, 200, 4)), ((196 + k) * 37) % 101,
                       sorted(((i * 37) % 101 for i in range(k, 200, 4)), reverse=True)[:2]) for k in range(4)}


def test_first_of_the_largest_at_the_ends_of_the_order(spark):
    """Places are whole numbers as they are: the order's ends do not overflow when ties go to the earliest."""
    ends = [(-2 ** 63, 5, "a"), (0, 5, "b"), (2 ** 63 - 1, 5, "c")]
    df = spark.createDataFrame([("k", *x) for x in ends], "k string, seq bigint, v int, name string")
    r = running(df, ["k"], ["seq"], [Agg("m", "max_by", "name", by="v"), Agg("f", "first", "name"), Agg("l", "last", "name")], buckets=3)
    assert [(x.m, x.f, x.l) for x in r.orderBy("seq").collect()] == [("a", "a", "a"), ("a", "a", "b"), ("a", "a", "c")]


def test_stream_of_triggers_equals_sql(spark):
    """win_global_trigger_stream keeps one log per scan of the batch: two."""
    rows = [(i, 100 * i, None if i % 9 == 0 else i % 5, "view", float(i * 31 % 97)) for i in range(300)]
    path = events(spark, scratch_path(spark, "triggers"), rows)
    out = C.STREAM_QUERIES["win_global_trigger_stream"](spark, path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{path.removeprefix('file:')}/events.parquet/*.parquet')")
    want = con.execute(C.STREAM_ORACLE["win_global_trigger_stream"])
    cols = [c[0] for c in want.description]
    assert sorted(map(repr, want.fetchall())) == sorted(repr(tuple(r)) for r in out.select(*cols).collect())


def test_rolled_files_take_few_calls(spark, monkeypatch):
    """A second run replaces the files; names with odd characters are kept as Spark writes them."""
    df = spark.range(400).selectExpr("id AS seq", "id * 60 AS ts")
    lines = files.rolled_lines(df, files.Rolling("a, b", ".txt", max_bytes=100), line=F.rpad(F.col("seq").cast("string"), 19, "x"))
    path = files.write_rolled_text(lines, scratch_path(spark, "rolled"))
    got = {(r.bucket, r.cnt, r.n_bytes) for r in files.read_rolled_files(spark, path).collect()}
    assert len(got) == 7 and {n for _, _, n in got} == {100}
    assert files.read_rolled_files(spark, path).count() == 80
    files.write_rolled_text(lines, path)
    assert files.read_rolled_files(spark, path).agg(F.sum("cnt")).first()[0] == 400
