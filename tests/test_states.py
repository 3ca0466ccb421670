"""State that a stream keeps: by change, replayed, without rows, with nulls; firings, late sides and expiry."""

import duckdb
import pytest
from pyspark.sql import functions as F

from sensorflow.operators import scan, state, topn, windows
from sensorflow.session import path_exists, scratch_path
from sensorflow.sources import tables as T
from sensorflow.streaming import catalog as C
from sensorflow.streaming import harness as H
from sensorflow.streaming.states import KeyedLog, Ledger, RowLog

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


def events(spark, path, rows):
    """An events table of (id, seconds, user, kind, value) rows."""
    df = spark.createDataFrame(rows, "event_id bigint, s bigint, user_id bigint, event_type string, value double")
    df.select("event_id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value") \
        .write.parquet(f"{path}/events.parquet")
    return path


def test_keyed_log_writes_what_changes(spark):
    """Every batch writes its own keys; merges add about log(batches) rewrites; reads give the newest state."""
    schema = "k struct<id:string>, v bigint"
    path = scratch_path(spark, "log")
    log = KeyedLog(spark, path, spark.createDataFrame([], schema).schema, key="k", fan=3)
    want = {}

    def changed(b):
        # a null key is a key
        rows = [((None,), b)] if b % 4 == 0 else []
        return rows + [((f"k{(7 * b + i) % 20}",), 100 * b + i) for i in range(3)]

    for b in range(11):
        for again in range(2):  # a batch that runs twice writes the same
            log.write(b, spark.createDataFrame(changed(b), schema))
        for (k,), v in changed(b):
            want[k] = v
        assert spark.read.schema(schema).parquet(f"{path}/{b}-{b + 1}").count() == len(changed(b))
        assert {r.k.id: r.v for r in log.read(b + 1).collect()} == want
    assert log.segments(11) == [(0, 9), (9, 10), (10, 11)]
    some = spark.createDataFrame([(("k1",),), ((None,),), (("new",),), (("k1",),)], "k struct<id:string>")
    assert {r.k.id: r.v for r in log.read(11, some).collect()} == {"k1": want["k1"], None: want[None]}
    assert path_exists(spark, f"{path}/0-9") and not path_exists(spark, f"{path}/0-1") and not path_exists(spark, f"{path}/0-3")


def test_keyed_log_leaves_out_states_that_are_gone(spark):
    log = KeyedLog(spark, scratch_path(spark, "log"), spark.createDataFrame([], "k int, v bigint").schema, key="k", fan=2)
    for b in range(4):
        log.write(b, spark.createDataFrame([(b, b)], "k int, v bigint"), gone=F.col("v") < 2)
    assert sorted(r.k for r in log.read(4).collect()) == [2, 3]


def test_row_log_and_ledger(spark):
    log = RowLog(spark, scratch_path(spark, "rows"), spark.createDataFrame([], "a int").schema)
    assert log.read([]).count() == 0
    log.write(0, spark.range(3).selectExpr("CAST(id AS INT) AS a"))
    log.write(2, spark.range(5).selectExpr("CAST(id AS INT) AS a"))
    assert log.read([0, 2]).count() == 8
    log.drop([0])
    assert not path_exists(spark, log.folder(0)) and log.read([2]).count() == 5
    ledger = Ledger(spark, scratch_path(spark, "ledger"), "top bigint, live array<struct<batch:bigint,until:bigint>>", {"top": None, "live": []})
    assert ledger.read(-1) == {"top": None, "live": []}
    ledger.write(0, {"top": 5, "live": [(0, 7)]})
    assert ledger.read(0) == {"top": 5, "live": [{"batch": 0, "until": 7}]}


def test_scan_on_a_stream_writes_the_keys_of_the_batch(spark):
    """Forty keys so far, two in the next batch: two states are written."""
    path = scratch_path(spark, "scan")
    first = spark.range(400).selectExpr("id AS seq", "concat('k', id % 40) AS id", "CAST(id % 7 AS INT) AS vc")
    second = spark.createDataFrame([(400, "k1", 5), (401, "k2", 6), (402, "k1", 7)], "seq bigint, id string, vc int")
    aggs = [scan.Agg("s", "sum", "vc"), scan.Agg("t", "topk", "vc", k=2)]
    whole = {r.seq: r for r in scan.running(first.union(second), ["id"], ["seq"], aggs).collect()}
    got = {}
    for b, part in enumerate((first, second)):
        got |= {r.seq: r for r in C.state_scan(spark, path, b)(part, ["id"], ["seq"], aggs).collect()}
    assert got == whole
    assert spark.read.parquet(f"{path}0/0-1").count() == 40 and spark.read.parquet(f"{path}0/1-2").count() == 2


STREAMS = ["broadcast_static_stream", "broadcast_asof_stream", "table_to_append_stream", "running_sum_stream", "win_elements_stream",
           "late_allowed_stream", "late_side_output_stream", "topn_window_stream", "join_late_sides_stream", "ttl_stream",
           "win_count_sliding_stream", "global_count_restart"]


@pytest.mark.parametrize("name", STREAMS)
def test_stream_without_rows(spark, name):
    path = events(spark, scratch_path(spark, "empty"), [])
    out = C.STREAM_QUERIES[name](spark, path)
    assert [tuple(r) for r in out.collect()] == ([(0,)] if name == "global_count_restart" else [])


def same_as_sql(spark, path, out, sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{path.removeprefix('file:')}/events.parquet/*.parquet')")
    want = con.execute(sql)
    cols = [c[0] for c in want.description]
    assert sorted(map(repr, want.fetchall())) == sorted(repr(tuple(r)) for r in out.select(*cols).collect())


@pytest.fixture(scope="module")
def with_nulls(spark):
    """Events of which a third have no user and a third no kind."""
    rows = [(i, 1_700_000_000 + 37 * i + (i * 7919) % 900, None if i % 3 == 0 else i % 5,
             None if i % 3 == 1 else ("error" if i % 7 == 0 else "view"), float(i * 31 % 97)) for i in range(300)]
    return events(spark, scratch_path(spark, "nulls"), rows)


@pytest.mark.parametrize("name", ["late_side_output", "broadcast_asof", "broadcast_static", "running_sum", "top2_changelog", "win_elements",
                                  "late_allowed", "win_count_tumbling"])
def test_null_ids_and_kinds(spark, with_nulls, name):
    from sensorflow.plans.catalog import QUERIES
    from sensorflow.plans.oracle import ORACLE
    same_as_sql(spark, with_nulls, QUERIES[name](spark, with_nulls), ORACLE[name])
    same_as_sql(spark, with_nulls, C.STREAM_QUERIES[f"{name}_stream"](spark, with_nulls), ORACLE[name])


def test_top_n_of_a_window_with_many_values(spark):
    """100,000 values in one window: at most N rows of it per task go into the shuffle."""
    counts = spark.range(100_000).selectExpr("id DIV 1000000 AS win_start", "3600 + id DIV 1000000 AS win_end", "CAST(id AS INT) AS vc", "id % 977 AS cnt")
    top = topn.first_n(counts, 3)
    assert [(r.vc, r.cnt) for r in top.orderBy("rank").collect()] == [(976, 976), (1953, 976), (2930, 976)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "collect_list" not in plan


def test_rows_behind_the_watermark_are_dropped_and_counted(spark):
    """EVT-3 with a delay smaller than the disorder."""
    rows = [(i, i * 60, "a") for i in range(100)] + [(200, 30, "late"), (201, 99 * 60, "a")]
    df = spark.createDataFrame(rows, "place bigint, ts bigint, id string").selectExpr("place", "ts", "id", "1 AS vc", "timestamp_seconds(ts) AS t")
    queries = []

    def start(src, run):
        q = H.append_sink(windows.tumbling(src.withWatermark("t", "10 minutes"), 600, ["id"]), run, "dropping")
        queries.append(q)
        return q
    run = H.replay(spark, "dropping", df, "place", 4, start)
    got = {(r.id, r.win_start): r.cnt for r in H.read_append(spark, run).collect()}
    assert ("late", 0) not in got and sum(got.values()) == 101
    dropped = sum(s["numRowsDroppedByWatermark"] for q in queries for p in q.recentProgress for s in p["stateOperators"])
    assert dropped == 1


def test_ttl_stream_drops_expired_states(spark):
    """A key that is silent for the time to live is gone from the merged log; what it held is not found again."""
    rows = [(0, "old", 0, 50), (1, "new", 10, 60)] + [(2 + i, "new", 100_000 * (i + 1), 70 + i) for i in range(8)] + [(20, "old", 900_000, 5)]
    df = spark.createDataFrame(rows, "seq bigint, id string, ts bigint, vc int")
    want = {r.seq: r.state for r in state.ttl_last_value(df, 150_000).collect()}
    path, got, top = scratch_path(spark, "ttl"), {}, 0
    for b, row in enumerate(rows):
        top = max(top, row[2])
        part = spark.createDataFrame([row], df.schema)
        gone = F.col("__s0.v") + 150_000 <= top
        got |= {r.seq: r.state for r in state.ttl_last_value(part, 150_000, scan=C.state_scan(spark, path, b, gone)).collect()}
    assert got == want
    assert [r[scan.KEY].id for r in spark.read.parquet(f"{path}0/0-8").collect()] == ["new"]


@pytest.mark.parametrize("purge", [False, True])
def test_user_trigger(spark, purge):
    df = spark.createDataFrame([(i, "a" if i < 7 else None, i) for i in range(10)], "seq bigint, id string, vc int")
    got = [(r.seq, r.firing, r.cnt, r.vc_sum) for r in
           windows.global_trigger(df, ["id"], windows.Trigger(when=F.col("vc") % 3 == 2, purge=purge)).orderBy("seq").collect()]
    assert got == ([(2, 1, 3, 3), (5, 2, 3, 12), (8, 1, 2, 15)] if purge else [(2, 1, 3, 3), (5, 2, 6, 15), (8, 1, 2, 15)])
    with pytest.raises(ValueError):
        windows.global_trigger(df, ["id"], windows.Trigger())


def test_change_of_ranks(spark):
    df = spark.createDataFrame([(0, "a", 5), (1, "a", 5), (2, "a", 3), (3, "a", 9), (4, "a", -1), (5, "a", None)], "seq bigint, id string, vc int")
    got = [(r.seq, r.op, r.value, r.rank) for r in topn.top_changelog(df).orderBy("seq", "pos").collect()]
    assert got == [(0, "+I", 5, 1), (1, "+I", 5, 2), (3, "-U", 5, 1), (3, "+U", 9, 1)]


def test_late_sides_on_a_stream_wait_no_longer_than_needed(spark):
    """Folders of accepted rows go once progress has passed all possible partners."""
    path = events(spark, scratch_path(spark, "sides"),
                  [(i, 1_700_000_000 + 900 * i, i % 3, "view" if i % 2 else "error", float(i % 50)) for i in range(400)])
    pairs, late = C._interval_join_with_late(spark, path, "sides_test")
    from sensorflow.plans.oracle import ORACLE
    same_as_sql(spark, path, pairs, ORACLE["join_interval_late"])
    same_as_sql(spark, path, late, ORACLE["join_late_sides"])
    root = pairs.inputFiles()[0].split("/sink/")[0]
    assert not path_exists(spark, f"{root}/accepted/batch0") and path_exists(spark, f"{root}/accepted/batch3")
