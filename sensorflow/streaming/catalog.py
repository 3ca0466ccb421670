"""Registered streaming queries: each replays a test table through a real
Structured Streaming query (see :mod:`sensorflow.streaming.harness`) and
returns what its sink holds.  Each has the same oracle as its batch twin.
"""

from __future__ import annotations

import os
from itertools import count

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.scalar import java_split
from sensorflow.operators import bridge, eventtime, joins, keyed, scan, state, topn, transforms, windows
from sensorflow.operators.scan import dealt
from sensorflow.plans import params as P
from sensorflow.plans.oracle import ORACLE, S
from sensorflow.session import path_exists, prepare
from sensorflow.sources import tables as T
from sensorflow.streaming import harness as H
from sensorflow.streaming.states import KeyedLog, Ledger, RowLog

N_BATCHES = 4
STREAM_DELAY_S = 1800     # >= the test data's largest disorder: no row is dropped


def _arrivals(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    return T.arrivals(spark, sf).select("seq", "id", "kind", "ts", "vc", "t", "arrival")


def _twin_order(spark: SparkSession, sf: str) -> DataFrame:
    """Rows in event order (seq): the order the batch twins of keyed state use."""
    return _arrivals(spark, sf)


# ---- windows -------------------------------------------------------------------

def s_win_tumbling_stream(spark, sf):
    def start(src, run):
        agg = windows.tumbling(src.withWatermark("t", f"{STREAM_DELAY_S} seconds"), P.WINDOW_S, ["id"])
        return H.append_sink(agg, run, "win_tumbling_stream")
    run = H.replay(spark, "win_tumbling", _arrivals(spark, sf), "arrival", N_BATCHES, start)
    return H.read_append(spark, run)


def s_win_sliding_stream(spark, sf):
    def start(src, run):
        agg = windows.sliding(src.withWatermark("t", f"{STREAM_DELAY_S} seconds"), P.WINDOW_S, P.SLIDE_S, ["id"])
        return H.append_sink(agg, run, "win_sliding_stream")
    run = H.replay(spark, "win_sliding", _arrivals(spark, sf), "arrival", N_BATCHES, start)
    return H.read_append(spark, run)


def s_win_session_stream(spark, sf):
    """Streaming sessions use Spark's native ``session_window`` (merged per key in the state store)."""
    def start(src, run):
        g = (src.withWatermark("t", f"{STREAM_DELAY_S} seconds")
             .groupBy(F.session_window("t", f"{P.SESSION_GAP_S} seconds").alias("w"), "id")
             .agg(*windows.default_aggs()))
        return H.append_sink(windows.with_bounds(g), run, "win_session_stream")
    run = H.replay(spark, "win_session", _arrivals(spark, sf), "arrival", N_BATCHES, start)
    return H.read_append(spark, run)


def s_wm_monotonous_stream(spark, sf):
    """Monotonous watermark (delay 0) on a stream in event order: nothing is late."""
    def start(src, run):
        agg = windows.tumbling(src.withWatermark("t", "0 seconds"), P.WINDOW_S, ["id"])
        return H.append_sink(agg, run, "wm_monotonous_stream")
    run = H.replay(spark, "wm_mono", _arrivals(spark, sf), "seq", N_BATCHES, start)
    return H.read_append(spark, run)


# ---- keyed aggregation ------------------------------------------------------------

def s_word_count_stream(spark, sf):
    prepare(spark)
    lines = T.text_lines(spark, sf)

    def start(src, run):
        words = src.select(F.explode(java_split(F.col("value"), " ")).alias("word"))
        return H.batch_folder_sink(keyed.word_count(words), run, "word_count_stream")
    run = H.replay(spark, "word_count", lines, "doc_id", N_BATCHES, start, fmt="text",
                   text_col="line", flush=False)
    return H.read_latest(spark, run, ["word"])


def s_word_count_restart(spark, sf):
    """Stateful word count restarted from its checkpoint for every micro-batch
    (stop / resume with the same query name and checkpoint)."""
    prepare(spark)
    lines = T.text_lines(spark, sf)

    def start(src, run):
        words = src.select(F.explode(java_split(F.col("value"), " ")).alias("word"))
        return H.batch_folder_sink(keyed.word_count(words), run, "word_count_restart")
    run = H.replay(spark, "word_count_restart", lines, "doc_id", N_BATCHES, start, fmt="text",
                   text_col="line", flush=False, restart_each_batch=True)
    return H.read_latest(spark, run, ["word"])


def s_word_count_changed_plan(spark, sf):
    """A word count that is stopped and goes on in another job: the first one's state is read from
    its checkpoint as a table and enters the second, which weighs its rows (sum instead of count,
    other columns, an own checkpoint), as its first rows."""
    prepare(spark)
    lines = T.text_lines(spark, sf)
    half = lines.agg(F.percentile_approx("doc_id", 0.5)).scalar()
    first, second = lines.where(F.col("doc_id") <= half), lines.where(~F.coalesce(F.col("doc_id") <= half, F.lit(False)))

    def count_rows(src, run):
        words = src.select(F.explode(java_split(F.col("value"), " ")).alias("word"))
        return H.batch_folder_sink(keyed.word_count(words), run, "word_count_first_plan")
    stopped = H.replay(spark, "word_count_first_plan", first, "doc_id", 2, count_rows, fmt="text", text_col="line", flush=False)
    state = H.saved_state(spark, stopped, "word string", "cnt bigint")
    words = second.select(F.col("doc_id").cast("bigint").alias("place"), F.explode(java_split(F.col("line"), " ")).alias("word"))
    rows = state.select(F.lit(None).cast("bigint").alias("place"), "word", "cnt").unionByName(
        words.select("place", "word", F.lit(1).cast("bigint").alias("cnt")))

    def add_up(src, run):
        return H.batch_folder_sink(src.groupBy("word").agg(F.sum("cnt").alias("cnt")), run, "word_count_changed_plan")
    run = H.replay(spark, "word_count_changed_plan", rows, "place", 2, add_up, flush=False)
    return H.read_latest(spark, run, ["word"])


def s_sink_bucketed_files_stream(spark, sf):
    """Row-format text sink with hourly bucket folders, written by a stream,
    read back and counted per bucket."""
    from sensorflow.sinks import files as file_sinks

    def start(src, run):
        return file_sinks.start_bucketed_text_stream(src, run.sink, run.checkpoint, run.writer_trigger())
    run = H.replay(spark, "bucketed_files", _arrivals(spark, sf), "arrival", N_BATCHES, start, flush=False)
    return file_sinks.read_bucket_counts(spark, run.sink)


def s_broadcast_static_stream(spark, sf):
    """Stream-static form of the broadcast config: the newest threshold of
    the (static) config table is one scalar, applied to every streamed row."""
    cfg = T.config_log(spark, sf)

    def start(src, run):
        data = src.where(~T.is_config()).select("seq", "id", "vc")
        return H.append_sink(joins.static_threshold_alerts(data, cfg), run, "broadcast_static_stream")
    run = H.replay(spark, "broadcast_static", _arrivals(spark, sf), "arrival", N_BATCHES, start, flush=False)
    return H.read_append(spark, run)


def s_broadcast_asof_stream(spark, sf):
    """Dynamic broadcast config on a stream: each row meets the newest threshold
    that came before it, also from an earlier batch (the carried state)."""
    def op(d, scan):
        data = d.where(~T.is_config()).select("seq", "id", "vc", *dealt(d))
        cfg = d.where(T.is_config()).select("seq", F.col("vc").alias("threshold"), *dealt(d))
        return joins.asof_threshold_alerts(data, cfg, scan=scan)
    return _carried("broadcast_asof_stream", sf, spark, op)


def s_global_count_restart(spark, sf):
    """Running global count, complete mode, restarted from its checkpoint every batch."""
    def start(src, run):
        return H.batch_folder_sink(src.groupBy().agg(F.count(F.lit(1)).alias("cnt")), run,
                                   "global_count_restart", mode="complete")
    run = H.replay(spark, "global_count", _arrivals(spark, sf), "arrival", N_BATCHES, start, flush=False,
                   restart_each_batch=True)
    return H.read_batches(spark, run).agg(F.coalesce(F.max_by("cnt", "batch"), F.lit(0)).alias("cnt"))


CARRIED = ["seq", "id", "kind", "ts", "vc"]


def _carried(name, sf, spark, op, ttl_s=None):
    """A running scan over a stream: each micro-batch is scanned in two levels, so a
    hot key is spread over its order buckets, and goes on from the states of its keys.
    Only those states are read and written again.  The buckets are the ranges that the
    stream was staged in, so no batch looks for cuts of its own.  With ``ttl_s`` the state of a key
    whose last row is so far back that no row can find it alive goes at the next merge."""
    data = _twin_order(spark, sf).select(*CARRIED)
    cols = [*CARRIED, scan.BUCKET]

    def start(src, run):
        run.schema = op(src.sparkSession.createDataFrame([], src.select(*cols).schema), scan.running).schema
        clock = Ledger(spark, os.path.join(run.root, "clock"), "now bigint", {"now": None})

        def write(bdf, bid):
            rows = bdf.select(*cols)
            held = []
            try:
                gone = None
                if ttl_s is not None:
                    seen = [x for x in (clock.read(bid - 1)["now"], rows.agg(F.max("ts")).first()[0]) if x is not None]
                    clock.write(bid, {"now": max(seen, default=None)})
                    # the time of a key's last row is the first state of both scans of this operator
                    gone = F.col("__s0.v") + ttl_s <= max(seen, default=0) - STREAM_DELAY_S
                op(rows, state_scan(spark, os.path.join(run.root, "state"), bid, gone, held)).write.mode("overwrite") \
                    .parquet(H.batch_folder(run, bid))
            finally:
                for x in held:
                    x.unpersist()
        return H.foreach_batch(src, run, name, write)
    run = H.replay(spark, name, data, "seq", N_BATCHES, start, flush=False, ranges=True)
    return H.read_batches(spark, run).drop("batch")


def state_scan(spark, path, bid, gone=None, held=None):
    """``scan.running`` for batch ``bid`` of a stream: it goes on from the states of the batch's
    keys after earlier batches and writes theirs after this one.  An operator's scans have a log each.

    Both steps go by the states of the rows' buckets, if they come with one, and the states before.  With
    ``held`` these are computed once: they are persisted and put on that list, for the caller to let go."""
    numbers = count()

    def once(df):
        if held is None:
            return df
        held.append(df.persist())
        return held[-1]

    def scan_rows(df, keys, order, aggs, keep=False):
        number = next(numbers)
        if scan.KEY in df.columns:  # another scan's result
            df = once(df)
        log = KeyedLog(spark, f"{path}{number}", scan.end_states(df, keys, order, aggs).schema)
        states, before = None, None
        if scan.BUCKET in df.columns:
            states = once(scan.bucket_states(df, keys, order, aggs))
        if log.segments(bid):
            here = states.select(scan.KEY) if states is not None else df.select(scan.key_column(keys))
            before = once(log.read(bid, here.distinct()))
        log.write(bid, scan.end_states(df, keys, order, aggs, initial=before, states=states), gone)
        return scan.running(df, keys, order, aggs, keep=keep, initial=before, states=states)
    return scan_rows


def _count_windows(name, sf, spark, places, number, full):
    """Count windows on a stream: a batch's complete windows fire; the rows of the others wait as
    a list per key, shorter than the copies of a window's rows, and only the batch's keys' lists are written."""
    cols = ["seq", "id", "ts", "vc", scan.BUCKET]
    data = _twin_order(spark, sf).select(*cols[:-1])

    def start(src, run):
        shape = places(spark.createDataFrame([], src.select(*cols).schema), scan.running)
        run.schema = windows.fired(shape, ["id"], number, full).schema
        packed = F.collect_list(F.struct(*shape.columns)).alias("waiting")

        def write(bdf, bid):
            rows = bdf.select(*cols)
            held = []
            try:
                here = places(rows, state_scan(spark, os.path.join(run.root, "state"), bid, held=held))
                key = scan.key_column(["id"])
                log = KeyedLog(spark, os.path.join(run.root, "waiting"), here.groupBy(key).agg(packed).schema)
                keys = rows.select(key).distinct()
                here = here.unionByName(log.read(bid, keys).select(F.inline("waiting"))).persist()
                held.append(here)
                counts = windows.counted(here, ["id"], number).persist()
                held.append(counts)
                counts.where(full).drop("__last_rn").write.mode("overwrite").parquet(H.batch_folder(run, bid))
                # the windows that wait are few, one or two a key; computed before the join, so that it knows
                wait = counts.where(~F.coalesce(full, F.lit(False))).select(key, number).persist()
                held.append(wait)
                wait.count()
                left = here.withColumn(scan.KEY, key).join(wait, [scan.KEY, number], "left_semi")
                lists = left.groupBy(scan.KEY).agg(packed)
                none = F.array().cast(log.schema["waiting"].dataType)
                log.write(bid, keys.join(lists, scan.KEY, "left").withColumn("waiting", F.coalesce("waiting", none)))
            finally:
                for x in held:
                    x.unpersist()
        return H.foreach_batch(src, run, name, write)
    run = H.replay(spark, name, data, "seq", N_BATCHES, start, flush=False, ranges=True)
    return H.read_batches(spark, run).drop("batch")


def s_running_reduce_stream(spark, sf):
    return _carried("running_reduce_stream", sf, spark, lambda d, scan: keyed.running_reduce(d, scan=scan))


def s_running_sum_stream(spark, sf):
    return _carried("running_sum_stream", sf, spark, lambda d, scan: keyed.running_sum(d, scan=scan))


def s_running_avg_stream(spark, sf):
    def op(d, scan):
        r = keyed.running_avg(d, scan=scan)
        return r.withColumn("avg_vc", F.round("avg_vc", 6))
    return _carried("running_avg_stream", sf, spark, op)


def s_topn_window_stream(spark, sf):
    """Top-2 values by count per sliding window: the counts of a window leave the streaming
    aggregation together when the watermark passes its end, and their batch is cut to the
    first two with at most two rows per window and task on the way."""
    def start(src, run):
        counts = topn.window_counts(src.withWatermark("t", f"{STREAM_DELAY_S} seconds"), P.WINDOW_S, P.SLIDE_S)
        run.schema = topn.first_n(spark.createDataFrame([], counts.schema), P.TOPN).schema

        def write(bdf, bid):
            topn.first_n(bdf, P.TOPN).write.mode("overwrite").parquet(H.batch_folder(run, bid))
        return H.foreach_batch(counts, run, "topn_window_stream", write)
    run = H.replay(spark, "topn_window", _arrivals(spark, sf), "arrival", N_BATCHES, start)
    return H.read_batches(spark, run).drop("batch").withColumn("rank", F.col("rank").cast("int"))


def s_top2_changelog_stream(spark, sf):
    return _carried("top2_changelog_stream", sf, spark, lambda d, scan: topn.top_changelog(d, n=P.TOPN, scan=scan))


def s_ttl_stream(spark, sf):
    return _carried("ttl_stream", sf, spark, lambda d, scan: state.ttl_last_value(d, P.TTL_S, P.ALERT_VC, scan=scan), ttl_s=P.TTL_S)


def s_win_global_trigger_stream(spark, sf):
    return _carried("win_global_trigger_stream", sf, spark,
                    lambda d, scan: windows.triggers_compared(d, P.TRIGGER_EVERY, P.TRIGGER_VC, scan=scan))


def s_delta_alert_stream(spark, sf):
    return _carried("delta_alert_stream", sf, spark, lambda d, scan: state.delta_alert(d, P.ALERT_VC, scan=scan))


def s_changelog_stream(spark, sf):
    return _carried("changelog_stream", sf, spark, lambda d, scan: bridge.changelog_group_sum(d, scan=scan))


def s_win_count_tumbling_stream(spark, sf):
    return _count_windows("count_tumbling_stream", sf, spark,
                          lambda d, scan: windows.tumbling_places(d, P.COUNT_SIZE, ["id"], ["seq"], scan),
                          "window_no", F.col("cnt") == P.COUNT_SIZE)


def s_win_count_sliding_stream(spark, sf):
    return _count_windows("count_sliding_stream", sf, spark,
                          lambda d, scan: windows.sliding_places(d, P.COUNT_SIZE, P.COUNT_SLIDE, ["id"], ["seq"], scan),
                          "fire_no", F.col("__last_rn") == F.col("fire_no"))


def s_vc_count_running_stream(spark, sf):
    return _carried("vc_count_stream", sf, spark, lambda d, scan: state.vc_count_running(d, scan=scan))


def s_running_top3_stream(spark, sf):
    def op(d, scan):
        r = topn.running_topk(d, P.TOPK_RUNNING, scan=scan)
        return r.select("seq", "id", "vc", *[F.get(F.col("top"), i).alias(f"top{i + 1}") for i in range(3)])
    return _carried("running_top3_stream", sf, spark, op)


# ---- sources / routing / sets --------------------------------------------------------

def s_src_file_stream(spark, sf):
    prepare(spark)
    lines = T.lines(spark, sf)

    def start(src, run):
        return H.append_sink(transforms.parse_sensor(src), run, "src_file_stream")
    run = H.replay(spark, "src_file", lines, "arrival", N_BATCHES, start, fmt="text", text_col="value",
                   flush=False)
    return H.read_append(spark, run)


def s_split_routes_stream(spark, sf):
    """One pass per micro-batch: the tagged batch is persisted once and each
    route is written to its own sink folder."""
    def start(src, run):
        tagged = transforms.route(src.select("seq", "id", "ts", "vc"),
                                  {"s1": F.col("id") == "s1", "s2": F.col("id") == "s2"})

        def write(bdf, bid):
            bdf.persist()
            try:
                for r in ("s1", "s2", "main"):
                    (bdf.where(F.col("route") == r).drop("route").write.mode("overwrite")
                     .parquet(os.path.join(run.sink, f"route={r}", f"batch={bid}")))
            finally:
                bdf.unpersist()
        run.schema = tagged.schema
        return H.foreach_batch(tagged, run, "split_routes_stream", write)
    run = H.replay(spark, "split_routes", _arrivals(spark, sf), "arrival", N_BATCHES, start, flush=False)
    return H.read_batches(spark, run).select("route", "seq", "id", "ts", "vc")


def s_union_all_stream(spark, sf):
    def start(src, run):
        a = src.where(F.col("kind") == "view").select("seq", F.col("vc").alias("value"))
        b = src.where(F.col("kind") == "click").select("seq", F.col("vc").alias("value"))
        rest = ~F.coalesce(F.col("kind").isin("view", "click"), F.lit(False))
        c = src.where(rest).select("seq", F.col("vc").cast("string").cast("int").alias("value"))
        return H.append_sink(transforms.union_all(a, b, c), run, "union_all_stream")
    run = H.replay(spark, "union_all", _arrivals(spark, sf), "arrival", N_BATCHES, start, flush=False)
    return H.read_append(spark, run)


def s_table_to_append_stream(spark, sf):
    """Streaming DataFrame -> temp view -> SQL -> append-only stream."""
    def start(src, run):
        src.createOrReplaceTempView("sensor_stream")
        res = spark.sql(f"SELECT seq, id, ts, vc FROM sensor_stream WHERE ts > {P.TS_CUT}")
        return H.append_sink(res, run, "table_to_append_stream")
    run = H.replay(spark, "table_append", _arrivals(spark, sf), "arrival", N_BATCHES, start, flush=False)
    return H.read_append(spark, run)


def s_exactly_once_pipeline(spark, sf):
    """Checkpointed query with an idempotent batch-id-keyed sink.  Batch 1
    fails after writing part of its output; the restart replays it and the
    overwrite by batch id leaves no duplicate and no loss."""
    crash = {"failed": False}

    def start(src, run):
        def write(bdf, bid):
            path = os.path.join(run.sink, f"batch={bid}")
            if bid == 1 and not crash["failed"]:
                bdf.limit(1).write.mode("overwrite").parquet(path)   # partial output, then crash
                crash["failed"] = True
                raise RuntimeError("injected failure after partial write")
            bdf.write.mode("overwrite").parquet(path)
        rows = src.select("seq", "id", "ts", "vc")
        run.schema = rows.schema
        return H.foreach_batch(rows, run, "exactly_once", write)

    def start_with_retry(src, run):
        q = start(src, run)
        try:
            q.awaitTermination()
        except StreamingQueryException as e:
            if "injected failure" not in str(e):
                raise
            # restart from the checkpoint
            return start(spark.readStream.schema(src.schema).parquet(f"{run.source}/*"), run)
        return q
    run = H.replay(spark, "exactly_once", _arrivals(spark, sf), "arrival", N_BATCHES, start_with_retry,
                   flush=False, restart_each_batch=True)
    return H.read_batches(spark, run).select("seq", "id", "ts", "vc")


# ---- joins ------------------------------------------------------------------------

def _sides(src):
    return T.sides(src)


def s_join_window_stream(spark, sf):
    def start(src, run):
        left, right = _sides(src.withWatermark("t", f"{STREAM_DELAY_S} seconds"))
        wl = left.select("id", F.window("t", f"{P.WINDOW_S} seconds").alias("w"),
                         *[F.col(c).alias(f"l_{c}") for c in ("seq", "ts", "vc")])
        wr = right.select("id", F.window("t", f"{P.WINDOW_S} seconds").alias("w"),
                          *[F.col(c).alias(f"r_{c}") for c in ("seq", "ts", "vc")])
        j = wl.join(wr, on=["id", "w"], how="inner")
        return H.append_sink(windows.with_bounds(j), run, "join_window_stream")
    run = H.replay(spark, "join_window", _arrivals(spark, sf), "arrival", N_BATCHES, start, flush=False)
    return H.read_append(spark, run)


def s_join_interval_stream(spark, sf):
    def start(src, run):
        left, right = _sides(src)
        l = left.select(F.col("id").alias("lid"), *[F.col(c).alias(f"l_{c}") for c in ("seq", "ts", "vc", "t")]) \
            .withWatermark("l_t", f"{STREAM_DELAY_S} seconds")
        r = right.select(F.col("id").alias("rid"), *[F.col(c).alias(f"r_{c}") for c in ("seq", "ts", "vc", "t")]) \
            .withWatermark("r_t", f"{STREAM_DELAY_S} seconds")
        cond = ((F.col("lid") == F.col("rid")) &
                F.expr(f"r_t >= l_t + INTERVAL {P.JOIN_LOWER_S} SECONDS AND "
                       f"r_t <= l_t + INTERVAL {P.JOIN_UPPER_S} SECONDS"))
        j = l.join(r, cond, "inner").select(F.col("lid").alias("id"), "l_seq", "l_ts", "l_vc", "r_seq", "r_ts", "r_vc")
        return H.append_sink(j, run, "join_interval_stream")
    run = H.replay(spark, "join_interval", _arrivals(spark, sf), "arrival", N_BATCHES, start, flush=False)
    return H.read_append(spark, run)


def s_join_connected_stream(spark, sf):
    """Keyed connect of two streams (orders, lineitems) = symmetric inner join
    without time bounds: each side's rows stay in state for later matches."""
    prepare(spark)
    o = T.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.lit("O").alias("side"),
                                            F.col("o_orderstatus").alias("x"), F.lit(None).cast("string").alias("y"),
                                            F.lit(None).cast("int").alias("n"))
    l = T.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.lit("L").alias("side"),
                                              F.lit(None).cast("string").alias("x"), F.col("l_returnflag").alias("y"),
                                              F.col("l_linenumber").alias("n"))
    both = o.unionByName(l)

    def start(src, run):
        left = src.where(F.col("side") == "O").select(F.col("k").alias("id"), "x")
        right = src.where(F.col("side") == "L").select(F.col("k").alias("lk"), "y", "n")
        j = joins.connect_join(left, right, "id", "lk").drop("lk")
        return H.append_sink(j, run, "join_connected_stream")
    run = H.replay(spark, "join_connected", both, "k", N_BATCHES, start, flush=False)
    return H.read_append(spark, run)


# ---- interval join with late sides ---------------------------------------------------

def _interval_join_with_late(spark, sf, name):
    """Interval join of two inputs whose progress is the minimum of both, on a stream.

    Progress is carried from batch to batch.  Rows behind it are late and go to their
    own output; the others meet the new and the waiting rows of the other side.  A batch's
    accepted rows are written once and its folder goes when progress has passed the last
    partner that any of them can have."""
    cols = ["side", "seq", "id", "ts", "vc"]
    data = _arrivals(spark, sf)
    lower, upper = P.JOIN_LOWER_S, P.JOIN_UPPER_S

    def start(src, run):
        ledger = Ledger(spark, os.path.join(run.root, "ledger"),
                        "lmax bigint, rmax bigint, live array<struct<batch:bigint,until:bigint>>", {"lmax": None, "rmax": None, "live": []})
        kinds = {f.name: f.dataType.simpleString() for f in src.schema}
        waiting = RowLog(spark, os.path.join(run.root, "accepted"),
                         spark.createDataFrame([], "side string, " + ", ".join(f"{c} {kinds[c]}" for c in cols[1:])).schema)

        def side(df, s):
            return df.where(F.col("side") == s).drop("side")

        run.schema = joins.interval_join(side(waiting.read([]), "L"), side(waiting.read([]), "R"), lower, upper).schema

        def write(bdf, bid):
            was = ledger.read(bid - 1)
            gone = {x["batch"] for x in ledger.read(bid - 2)["live"]} | {bid - 1} if bid else set()
            waiting.drop(gone - {x["batch"] for x in was["live"]} - {-1})
            rows = bdf.select("seq", "id", "kind", "ts", "vc", "t", "arrival").persist()
            try:
                flagged = eventtime.late_rows_two_inputs(*[d.drop("t") for d in T.sides(rows, "arrival")], P.DELAY_S,
                                                         ["arrival", "seq"], carry=(was["lmax"], was["rmax"]))
                flagged.where("late").select(*cols).write.mode("overwrite").parquet(os.path.join(run.root, "late", f"batch={bid}"))
                waiting.write(bid, flagged.where(~F.col("late")))
                top = rows.agg(F.max(F.when(T.is_left(), F.col("ts"))), F.max(F.when(~T.is_left(), F.col("ts")))).first()
            finally:
                rows.unpersist()
            new = waiting.read([bid])
            old = waiting.read(x["batch"] for x in was["live"])
            passed = eventtime.two_input_progress(was["lmax"], was["rmax"], P.DELAY_S)
            if passed is not None:  # rows whose last possible partner is behind the progress are not read
                last = F.when(F.col("side") == "L", F.col("ts") + upper).otherwise(F.col("ts") - lower)
                old = old.where(last * 1000 >= passed)
            pairs = joins.interval_join(side(new, "L"), side(new.union(old), "R"), lower, upper).union(
                joins.interval_join(side(old, "L"), side(new, "R"), lower, upper))
            pairs.write.mode("overwrite").parquet(H.batch_folder(run, bid))
            lmax, rmax = (max((x for x in pair if x is not None), default=None) for pair in zip((was["lmax"], was["rmax"]), top))
            now = eventtime.two_input_progress(lmax, rmax, P.DELAY_S)
            until = new.agg(F.max(F.when(F.col("side") == "L", F.col("ts") + upper).otherwise(F.col("ts") - lower))).first()[0]
            live = [(x["batch"], x["until"]) for x in was["live"]] + ([(bid, until)] if until is not None else [])
            ledger.write(bid, {"lmax": lmax, "rmax": rmax, "live": [x for x in live if now is None or x[1] * 1000 >= now]})
        return H.foreach_batch(src, run, name, write)
    run = H.replay(spark, name, data, "arrival", N_BATCHES, start, flush=False)
    late = os.path.join(run.root, "late")
    schema = T.sides(data)[0].select(F.lit("L").alias("side"), *cols[1:]).schema
    none = spark.createDataFrame([], schema)
    late_rows = spark.read.schema(schema).parquet(late).select(*cols) if path_exists(spark, late) else none
    return H.read_batches(spark, run).drop("batch"), late_rows


def s_join_interval_late_stream(spark, sf):
    return _interval_join_with_late(spark, sf, "join_interval_late_stream")[0]


def s_join_late_sides_stream(spark, sf):
    return _interval_join_with_late(spark, sf, "join_late_sides_stream")[1]


# ---- full-window function -------------------------------------------------------------

def s_win_elements_stream(spark, sf):
    """The rows of every window with its bounds and count, when the watermark passes its end.

    Rows wait in the folder of their batch.  A firing reads the folders that still hold open
    windows, counts the rows of the windows that close and hands the rows on as rows: no
    window is a list.  Windows still open when the input ends fire then."""
    cols = ["seq", "id", "ts", "vc"]
    data = _arrivals(spark, sf)
    kinds = {f.name: f.dataType.simpleString() for f in data.schema}
    bounded = spark.createDataFrame([], ", ".join(f"{c} {kinds[c]}" for c in cols) + ", win_start bigint, win_end bigint").schema

    def fired(rows):
        return windows.window_elements(rows.select(*cols), P.WINDOW_S)

    def passed(top):
        """Windows whose end the watermark has reached, given the latest time seen."""
        return F.lit(False) if top is None else F.col("win_end") <= top - STREAM_DELAY_S

    def parts(run):
        return (RowLog(spark, os.path.join(run.root, "rows"), bounded),
                Ledger(spark, os.path.join(run.root, "ledger"), "top bigint, live array<struct<batch:bigint,until:bigint>>",
                       {"top": None, "live": []}))

    def start(src, run):
        waiting, ledger = parts(run)
        run.schema = fired(spark.createDataFrame([], bounded)).schema

        def write(bdf, bid):
            was = ledger.read(bid - 1)
            held = {x["batch"]: x["until"] for x in was["live"]}
            if bid:
                waiting.drop(({x["batch"] for x in ledger.read(bid - 2)["live"]} | {bid - 1}) - set(held))
            begin = F.col("ts") - F.pmod(F.col("ts"), F.lit(P.WINDOW_S))
            rows = bdf.select(*cols).withColumn("win_start", begin).withColumn("win_end", begin + P.WINDOW_S)
            # a row whose window has fired is late; the delay is the disorder of this input, so there are none
            waiting.write(bid, rows.where(~F.coalesce(passed(was["top"]), F.lit(False))))
            new = waiting.read([bid]).agg(F.max("ts").alias("top"), F.max("win_end").alias("until")).first()
            top = max((x for x in (was["top"], new["top"]) if x is not None), default=None)
            every = waiting.read([*held, bid])
            fired(every.where(passed(top) & ~passed(was["top"]))).write.mode("overwrite").parquet(H.batch_folder(run, bid))
            if new["until"] is not None:
                held[bid] = new["until"]
            live = [(b, u) for b, u in held.items() if top is None or u > top - STREAM_DELAY_S]
            ledger.write(bid, {"top": top, "live": live})
        return H.foreach_batch(src, run, "win_elements_stream", write)
    run = H.replay(spark, "win_elements", data, "arrival", N_BATCHES, start, flush=False)
    out = H.read_batches(spark, run)
    waiting, ledger = parts(run)
    end = ledger.read(_last_batch(spark, ledger) if path_exists(spark, ledger.path) else -1)
    still = waiting.read(x["batch"] for x in end["live"]).where(~passed(end["top"]))
    return out.drop("batch").unionByName(fired(still))


def _last_batch(spark, ledger):
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger.path)
    names = [f.getPath().getName() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
    return max((int(n.removeprefix("batch")) for n in names), default=None)


# ---- late data --------------------------------------------------------------------

def _classified_stream(spark, sf, name: str, keep_late: bool):
    """Replay the arrivals and classify every row per record (on time /
    re-fire / too late) inside ``foreachBatch``.  The max event time of
    earlier batches is carried in a ledger, so a replayed batch reads the
    same carry; inside the batch the scan runs in arrival order.  Writes the
    late rows (``keep_late``) or the kept rows."""
    cols = ["seq", "id", "ts", "vc", "arrival"]
    order = ["arrival", "seq"]

    def classified(rows, top):
        cl = eventtime.classify_window_lateness(rows, P.WINDOW_S, P.DELAY_S, P.LATENESS_S, order, carry_max=top)
        out = cl.where(F.col("status") == "late") if keep_late else cl.where(F.col("status") != "late")
        return out.select(*cols, "win_start", "win_end", "status")

    def start(src, run):
        run.schema = classified(spark.createDataFrame([], src.select(*cols).schema), None).schema
        ledger = Ledger(spark, os.path.join(run.root, "ledger"), "top bigint", {"top": None})

        def write(bdf, bid):
            top = ledger.read(bid - 1)["top"]
            rows = bdf.select(*cols, scan.BUCKET).persist()
            try:
                classified(rows, top).write.mode("overwrite").parquet(H.batch_folder(run, bid))
                seen = [x for x in (top, rows.agg(F.max("ts")).first()[0]) if x is not None]
            finally:
                rows.unpersist()
            ledger.write(bid, {"top": max(seen, default=None)})
        return H.foreach_batch(src, run, name, write)
    run = H.replay(spark, name, _arrivals(spark, sf).select(*cols), "arrival", N_BATCHES, start, flush=False, ranges=True)
    return H.read_batches(spark, run).drop("batch")


def s_late_side_output_stream(spark, sf):
    """Late side output on a stream: rows whose window was already destroyed."""
    late = _classified_stream(spark, sf, "late_side_output_stream", keep_late=True)
    return late.select("seq", "id", "ts", "vc", "arrival", "win_start")


def s_late_allowed_stream(spark, sf):
    """Allowed lateness on a stream: a window fires when the watermark passes its
    end and again for every row that is late but allowed; each firing is a row of
    the sink with the window's value then.  A batch writes the states of its own windows
    that are not destroyed yet; those that fire are known from these and the waiting ones.
    Only windows that fire again are scanned row by row.  Windows still open at the end of the input fire there.  The result is the last
    firing of each window."""
    keys = ["id", "win_start", "win_end"]
    on = F.col("status") == "on_time"
    aggs = [scan.Agg("cnt", "count"), scan.Agg("vc_sum", "sum", "vc"), scan.Agg("re", "sum", "is_re"),
            scan.Agg("on_cnt", "sum", "is_on"), scan.Agg("on_sum", "sum", "on_vc")]
    names = dict(zip((f"__s{i}" for i in range(len(aggs))), (x.name for x in aggs)))
    order = ["arrival", "seq"]
    rows_cols = ["seq", "id", "ts", "vc", "arrival"]
    data = _arrivals(spark, sf).select(*rows_cols)

    def marked(rows, top):
        kept = eventtime.classify_window_lateness(rows, P.WINDOW_S, P.DELAY_S, P.LATENESS_S, order, carry_max=top).where(F.col("status") != "late")
        return (kept.withColumn("is_re", F.when(on, 0).otherwise(1)).withColumn("is_on", F.when(on, 1).otherwise(0))
                .withColumn("on_vc", F.when(on, F.col("vc")).otherwise(0)))

    def first_firings(states):
        w = states.select(f"{scan.KEY}.*", *[F.col(s).alias(n) for s, n in names.items()]).where("on_cnt > 0")
        return w.select(*keys, F.col("on_cnt").cast("bigint").alias("cnt"), F.col("on_sum").cast("bigint").alias("vc_sum"),
                        F.lit(1).cast("bigint").alias("firings"))

    def progress(top):
        return None if top is None else top * 1000 - (P.DELAY_S * 1000 + 1)

    def passed(wm, end):
        return F.lit(False) if wm is None else end * 1000 - 1 <= wm

    def log_of(run):
        none = marked(spark.createDataFrame([], data.select(*rows_cols).schema), None)
        return KeyedLog(spark, os.path.join(run.root, "windows"), scan.end_states(none, keys, order, aggs).schema)

    def ledger_of(run):
        return Ledger(spark, os.path.join(run.root, "ledger"), "top bigint", {"top": None})

    def start(src, run):
        log, ledger = log_of(run), ledger_of(run)
        run.schema = first_firings(spark.createDataFrame([], log.schema)).schema

        def write(bdf, bid):
            was = ledger.read(bid - 1)["top"]
            # the staged range goes along as a column and is the bucket of both scans
            rows = bdf.select(*rows_cols, scan.BUCKET, F.col(scan.BUCKET).alias("range"))
            held = []

            def once(df):
                held.append(df.persist())
                return held[-1]
            try:
                top = max((x for x in (was, rows.agg(F.max("ts")).first()[0]) if x is not None), default=None)
                ledger.write(bid, {"top": top})
                wm, wm_was = progress(top), progress(was)
                here = once(marked(rows, was).withColumn(scan.KEY, scan.key_column(keys)).withColumnRenamed("range", scan.BUCKET))
                states = scan.end_states(here, keys, order, aggs)
                waiting = once(log.read(bid))
                # a window's states before and in this batch are brought together once: those of its own windows are new
                parts = states.withColumn("__new", F.lit(1)).union(waiting.withColumn("__new", F.lit(0)))
                both = once(parts.groupBy(scan.KEY).agg(*[F.sum(s).cast(log.schema[s].dataType).alias(s) for s in names], F.max("__new").alias("__new")))
                end = F.col(f"{scan.KEY}.win_end")
                # a window whose allowed lateness is over is never read again
                over = passed(wm, end + P.LATENESS_S)
                log.write(bid, both.where((F.col("__new") == 1) & ~F.coalesce(over, F.lit(False))), over)
                # computed before the joins, so that they know how few these are
                late = once(here.where("is_re = 1").select(scan.KEY).distinct())
                late.count()
                again = scan.running(here.join(late, scan.KEY, "left_semi"), keys, order, aggs, initial=waiting.join(late, scan.KEY, "left_semi")) \
                    .where("is_re = 1").select(
                        *keys, "cnt", F.col("vc_sum").cast("bigint"),
                        (F.col("re") + (F.col("on_cnt") > 0).cast("int")).cast("bigint").alias("firings"))
                fires = first_firings(both.where(passed(wm, end) & ~passed(wm_was, end)))
                again.unionByName(fires).write.mode("overwrite").parquet(H.batch_folder(run, bid))
            finally:
                for x in held:
                    x.unpersist()
        return H.foreach_batch(src, run, "late_allowed_stream", write)
    run = H.replay(spark, "late_allowed", data, "arrival", N_BATCHES, start, flush=False, ranges=True)
    fired = H.read_batches(spark, run)
    ledger = ledger_of(run)
    last = _last_batch(spark, ledger) if path_exists(spark, ledger.path) else None
    if last is not None:
        open_ = log_of(run).read(last + 1).where(~passed(progress(ledger.read(last)["top"]), F.col(f"{scan.KEY}.win_end")))
        fired = fired.drop("batch").unionByName(first_firings(open_))
    # plain numbers, not a maximum of structs, which would sort all firings; a window's firings are numbered
    return fired.groupBy(*keys).agg(F.max_by("cnt", "firings").alias("cnt"), F.max_by("vc_sum", "firings").alias("vc_sum"),
                                    F.max("firings").alias("firings"))


STREAM_QUERIES = {k[2:]: v for k, v in sorted(globals().items()) if k.startswith("s_") and callable(v)}

_TWINS = {
    "win_tumbling_stream": "win_tumbling", "win_sliding_stream": "win_sliding",
    "win_session_stream": "win_session", "wm_monotonous_stream": "win_tumbling",
    "word_count_stream": "word_count", "word_count_restart": "word_count",
    "word_count_changed_plan": "word_count",
    "sink_bucketed_files_stream": "sink_bucketed_files", "broadcast_static_stream": "broadcast_static",
    "broadcast_asof_stream": "broadcast_asof",
    "running_reduce_stream": "running_reduce",
    "delta_alert_stream": "delta_alert", "running_avg_stream": "running_avg",
    "running_sum_stream": "running_sum",
    "topn_window_stream": "topn_window", "changelog_stream": "changelog_sum",
    "win_count_tumbling_stream": "win_count_tumbling", "win_count_sliding_stream": "win_count_sliding",
    "vc_count_running_stream": "vc_count_running", "running_top3_stream": "running_top3",
    "split_routes_stream": "split_routes", "union_all_stream": "union_all",
    "table_to_append_stream": "sql_filter", "join_window_stream": "join_window",
    "join_interval_stream": "join_interval", "join_connected_stream": "join_connected",
    "top2_changelog_stream": "top2_changelog", "ttl_stream": "ttl_event_time", "win_global_trigger_stream": "win_global_trigger",
    "join_interval_late_stream": "join_interval_late", "join_late_sides_stream": "join_late_sides",
    "win_elements_stream": "win_elements",
    "late_side_output_stream": "late_side_output", "late_allowed_stream": "late_allowed",
}
STREAM_ORACLE = {k: ORACLE[v] for k, v in _TWINS.items()}
STREAM_ORACLE["src_file_stream"] = S + "SELECT id, ts, vc FROM sensor"
STREAM_ORACLE["global_count_restart"] = S + "SELECT count(*) AS cnt FROM sensor"
STREAM_ORACLE["exactly_once_pipeline"] = S + "SELECT seq, id, ts, vc FROM sensor"
