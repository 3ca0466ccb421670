"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Each entry reads the parquet tables (whole tables, whole texts) and runs
the library operator named by its key.  Column names match the DuckDB
spellings in :mod:`sensorflow.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.scalar import epoch_ms_format, java_hash, java_split
from sensorflow.operators import (bridge, distribution, eventtime, joins, keyed, state, topn,
                                  transforms, windows)
from sensorflow.plans import params as P
from sensorflow.session import prepare, scratch_path
from sensorflow.sinks import files as file_sinks
from sensorflow.sinks import queues, tables as table_sinks
from sensorflow.sources import tables as T

Query = Callable[[SparkSession, str], DataFrame]
ARRIVAL_ORDER = ["arrival", "seq"]


def _sensor(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    return T.sensor(spark, sf)


def _arrivals(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    return T.arrivals(spark, sf)


def _rows(df: DataFrame) -> DataFrame:
    return df.select("seq", "id", "ts", "vc")


def _rnd(c, n: int = 6):
    return F.round(c, n)


# ---- keyed aggregation -------------------------------------------------------

def q_filter_group_sum(spark, sf):
    return keyed.filter_group_sum(_sensor(spark, sf), P.FILTER_VC)


def q_filter_group_sum_sql(spark, sf):
    _sensor(spark, sf).createOrReplaceTempView("sensor")
    return spark.sql(f"SELECT id, CAST(sum(vc) AS BIGINT) AS sum_vc FROM sensor WHERE vc > {P.FILTER_VC} GROUP BY id")


def q_sql_group_sum(spark, sf):
    _sensor(spark, sf).createOrReplaceTempView("sensor")
    return spark.sql("SELECT id, CAST(sum(vc) AS BIGINT) AS sum_vc FROM sensor GROUP BY id")


def q_word_count(spark, sf):
    prepare(spark)
    return keyed.word_count(T.tokens(spark, sf))


def q_running_reduce(spark, sf):
    return keyed.running_reduce(_sensor(spark, sf))


def q_running_sum(spark, sf):
    return keyed.running_sum(_sensor(spark, sf))


def q_running_max(spark, sf):
    return keyed.running_extreme(_sensor(spark, sf), "max")


def q_running_min(spark, sf):
    return keyed.running_extreme(_sensor(spark, sf), "min")


def q_running_max_by(spark, sf):
    return keyed.running_extreme_by(_sensor(spark, sf), "max_by")


def q_running_min_by(spark, sf):
    return keyed.running_extreme_by(_sensor(spark, sf), "min_by")


def q_running_avg(spark, sf):
    r = keyed.running_avg(_sensor(spark, sf))
    return r.withColumn("avg_vc", _rnd(F.col("avg_vc")))


# ---- projections / filters ---------------------------------------------------

def q_map_project(spark, sf):
    return transforms.map_project(_sensor(spark, sf), "seq", "id")


def q_filter_eq(spark, sf):
    return _rows(transforms.filter_eq(_sensor(spark, sf), "id", "s1"))


def q_flatmap_conditional(spark, sf):
    return transforms.flatmap_conditional(_rows(_sensor(spark, sf))).select("seq", "pos", "value")


def q_map_lifecycle(spark, sf):
    s = _sensor(spark, sf).select("seq", F.col("vc").cast("string").alias("value"))
    return transforms.parse_int_plus_one(s)


def q_sql_filter(spark, sf):
    _sensor(spark, sf).createOrReplaceTempView("sensor")
    return spark.sql(f"SELECT seq, id, ts, vc FROM sensor WHERE ts > {P.TS_CUT}")


def q_select_rename(spark, sf):
    s = _sensor(spark, sf).select("id", "ts", "vc")
    return transforms.rename(s, {"id": "sensor_id", "ts": "event_ts", "vc": "water_level"})


def q_sql_nested_view(spark, sf):
    s = _sensor(spark, sf)
    s.createOrReplaceTempView("sensor")
    spark.sql(f"SELECT * FROM sensor WHERE vc > {P.FILTER_VC}").createOrReplaceTempView("tmp")
    return spark.sql(f"SELECT id, ts, vc FROM tmp WHERE ts > {P.TS_CUT}")


def q_scalar_functions(spark, sf):
    s = _sensor(spark, sf)
    l = s.select("seq", "id", "ts", "vc", T.sensor_line(s).alias("line"))
    parts = java_split(F.col("line"), ",")
    return l.select(
        "seq", parts[0].alias("id_part"), parts[1].cast("bigint").alias("ts_num"),
        parts[2].cast("int").alias("vc_num"),
        F.concat(F.col("id"), F.lit("#"), F.col("vc").cast("string")).alias("tag"),
        F.length("id").cast("int").alias("id_len"),
        java_hash("id", s.schema["id"].dataType).alias("id_hash"),
        F.abs(F.col("vc") - 50).alias("vc_dev"), F.greatest(F.col("vc"), F.lit(10)).alias("vc_floor10"),
        (F.col("vc") % 7).alias("vc_mod7"), (F.col("vc") + 1).alias("vc_plus1"),
        _rnd(F.col("vc") / 4).alias("vc_div4"),
        epoch_ms_format(F.col("ts") * 1000).alias("ts_text"),
        F.octet_length(F.encode(F.col("id"), "UTF-8")).cast("int").alias("id_bytes"),
        F.coalesce(F.nullif(F.col("vc"), F.lit(0)), F.lit(-1)).alias("vc_nz"),
        (F.col("vc") > 10).alias("high"))


# ---- splitting / combining ---------------------------------------------------

def q_split_even_odd(spark, sf):
    s = _sensor(spark, sf).select("seq", "vc")
    parts = transforms.split_by_filters(s, {"even": F.col("vc") % 2 == 0, "odd": F.col("vc") % 2 == 1})
    return transforms.union_all(*[d.select(F.lit(n).alias("stream"), "seq", "vc") for n, d in parts.items()])


def q_split_routes(spark, sf):
    s = _rows(_sensor(spark, sf))
    tagged = transforms.route(s, {"s1": F.col("id") == "s1", "s2": F.col("id") == "s2"})
    return tagged.select("route", "seq", "id", "ts", "vc")


def q_alert_threshold(spark, sf):
    main, warn = transforms.alert_side_output(_rows(_sensor(spark, sf)), P.ALERT_VC)
    return transforms.union_all(
        main.select(F.lit("main").alias("stream"), "seq", "id", "ts", "vc",
                    F.lit(None).cast("string").alias("message")),
        warn.select(F.lit("warn").alias("stream"), "seq", "id", "ts", "vc", "message"))


def q_union_all(spark, sf):
    s = _sensor(spark, sf)
    a = s.where(F.col("kind") == "view").select("seq", F.col("vc").alias("value"))
    b = s.where(F.col("kind") == "click").select("seq", F.col("vc").alias("value"))
    rest = ~F.coalesce(F.col("kind").isin("view", "click"), F.lit(False))
    c = s.where(rest).select("seq", F.col("vc").cast("string").alias("value"))
    return transforms.union_all(a, b, c.select("seq", F.col("value").cast("int").alias("value")))


def q_connect_map(spark, sf):
    s = _sensor(spark, sf)
    return transforms.connect_map(s.where(T.is_left()), s.where(~T.is_left()),
                                  F.col("vc").cast("string"), F.col("id"))


# ---- distribution ------------------------------------------------------------

def _parts(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def q_part_by_key(spark, sf):
    d = distribution.by_key(_rows(_sensor(spark, sf)), _parts(spark), "id")
    return (d.withColumn("pid", F.spark_partition_id())
            .groupBy("id").agg(F.countDistinct("pid").alias("n_partitions")))


def q_part_random(spark, sf):
    """Rows dealt at random: all are there, and no partition is far from its even share."""
    n = _parts(spark)
    d = distribution.random_shuffle(_rows(_sensor(spark, sf)), n).withColumn("pid", F.spark_partition_id())
    per = d.groupBy("pid").agg(F.count(F.lit(1)).alias("n"))
    share = F.sum("n") / n
    return per.agg(F.sum("n").alias("n_rows"), (F.count(F.lit(1)) == n).alias("all_used"),
                   (F.max(F.abs(F.col("n"))) <= share + 8 * F.sqrt(share)).alias("balanced"))


def q_part_round_robin(spark, sf):
    """Every input partition deals its rows one by one, so partitions differ by one row per input partition at most."""
    s = _rows(_sensor(spark, sf)).withColumn("from", F.spark_partition_id())
    d = distribution.round_robin(s, _parts(spark)).withColumn("pid", F.spark_partition_id())
    per = d.groupBy("pid", "from").agg(F.count(F.lit(1)).alias("n"))
    each = per.groupBy("from").agg(F.sum("n").alias("n"), (F.max("n") - F.min("n")).alias("gap"))
    return each.agg(F.sum("n").alias("n_rows"), (F.max("gap") <= 1).alias("balanced"))


def q_part_rescale(spark, sf):
    """Neighbouring partitions merged without a shuffle: no input partition is cut, every target takes several."""
    n = _parts(spark)
    s = _rows(_sensor(spark, sf)).repartition(3 * n).withColumn("from", F.spark_partition_id())
    d = distribution.rescale(s, n).withColumn("pid", F.spark_partition_id())
    pairs = d.groupBy("from", "pid").agg(F.count(F.lit(1)).alias("n"))
    per = pairs.groupBy("from").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("into"))
    total = per.agg(F.sum("n").alias("n_rows"), (F.max("into") == 1).alias("whole"))
    merged = pairs.groupBy("pid").agg(F.count(F.lit(1)).alias("took")).agg((F.min("took") >= 2).alias("merged"))
    return total.withColumn("merged", merged.scalar())


def q_part_replicate(spark, sf):
    """All rows to every partition: each replica is whole and where it belongs."""
    d = distribution.replicate(_rows(_sensor(spark, sf)), P.N_PARTS)
    d = d.withColumn("pid", F.spark_partition_id())
    return d.groupBy("replica").agg(F.count(F.lit(1)).alias("cnt"),
                                    F.sum((F.col("pid") != F.col("replica")).cast("bigint")).alias("misplaced"))


def q_part_custom(spark, sf):
    s = _rows(_sensor(spark, sf))
    n = _parts(spark)
    d = distribution.custom(s, n, F.expr("substring(id, 2)"))
    per = d.select("id", F.spark_partition_id().alias("part")).distinct()
    # the partition a key asks for, as a fact that holds for every partition count
    return per.select("id", (F.col("part") == F.expr("int(substring(id, 2))") % n).alias("as_asked"))


# ---- windows -----------------------------------------------------------------

def q_win_tumbling(spark, sf):
    return windows.tumbling(_sensor(spark, sf), P.WINDOW_S, ["id"])


def q_win_tumbling_arrival(spark, sf):
    return windows.tumbling(_arrivals(spark, sf), P.WINDOW_S, ["id"], time_col="at")


def q_win_sliding(spark, sf):
    return windows.sliding(_sensor(spark, sf), P.WINDOW_S, P.SLIDE_S, ["id"])


def q_win_sliding_arrival(spark, sf):
    return windows.sliding(_arrivals(spark, sf), P.WINDOW_S, P.SLIDE_S, ["id"], time_col="at")


def q_win_session(spark, sf):
    return windows.sessions(_rows(_sensor(spark, sf)), ["id"], gap_s=P.SESSION_GAP_S)


def q_win_session_dynamic(spark, sf):
    return windows.sessions(_rows(_sensor(spark, sf)), ["id"],
                            gap_col=F.col("vc").cast("bigint") * P.DYN_GAP_PER_VC_S)


def q_win_count_tumbling(spark, sf):
    return windows.count_tumbling(_rows(_sensor(spark, sf)), P.COUNT_SIZE, ["id"])


def q_win_count_sliding(spark, sf):
    return windows.count_sliding(_rows(_sensor(spark, sf)), P.COUNT_SIZE, P.COUNT_SLIDE, ["id"])


def q_win_global(spark, sf):
    return windows.global_window(_sensor(spark, sf), ["id"])


def q_win_global_trigger(spark, sf):
    return windows.triggers_compared(_sensor(spark, sf), P.TRIGGER_EVERY, P.TRIGGER_VC)


def q_win_all(spark, sf):
    return windows.all_window(_sensor(spark, sf), P.WINDOW_S)


def q_win_reduce(spark, sf):
    return windows.window_reduce(_sensor(spark, sf), P.WINDOW_S)


def q_win_aggregate(spark, sf):
    return windows.window_aggregate(_sensor(spark, sf), P.WINDOW_S)


def q_win_process(spark, sf):
    return windows.window_process(_sensor(spark, sf), P.WINDOW_S)


def q_win_elements(spark, sf):
    return windows.window_elements(_rows(_sensor(spark, sf)), P.WINDOW_S)


def q_win_agg_with_bounds(spark, sf):
    return windows.window_agg_with_bounds(_sensor(spark, sf), P.WINDOW_S)


def q_win_parity_groups(spark, sf):
    s = _sensor(spark, sf).withColumn("parity", F.col("vc") % 2)
    return windows.tumbling(s, P.WINDOW_S, ["parity"])


# ---- top-n -------------------------------------------------------------------

def q_topn_window(spark, sf):
    r = topn.topn_per_window(_sensor(spark, sf), P.WINDOW_S, P.SLIDE_S, P.TOPN)
    return r.withColumn("rank", F.col("rank").cast("int"))


def q_running_top3(spark, sf):
    r = topn.running_topk(_rows(_sensor(spark, sf)), P.TOPK_RUNNING)
    return r.select("seq", "id", "vc", *[F.get(F.col("top"), i).alias(f"top{i + 1}") for i in range(3)])


def q_top2_table_agg(spark, sf):
    r = topn.top2_table_aggregate(_sensor(spark, sf), "vc", ["id"], P.TOPN)
    return r.withColumn("rank", F.col("rank").cast("int"))


def q_top2_table_agg_udf(spark, sf):
    """The same Top2 through the generic user table-aggregate API (Python
    accumulators, partial per task + merge per key)."""
    from sensorflow.functions import table_agg as TA
    s = _sensor(spark, sf).select("id", "vc")
    return TA.table_aggregate(s, ["id"], ["vc"], TA.top2_create, TA.top2_accumulate, TA.top2_merge,
                              TA.top2_emit, "id string, value int, rank int",
                              accumulate_many=TA.top2_accumulate_many)


def q_top2_changelog(spark, sf):
    return topn.top_changelog(_sensor(spark, sf), n=P.TOPN)


# ---- keyed state (batch twins) -----------------------------------------------

def q_delta_alert(spark, sf):
    return state.delta_alert(_sensor(spark, sf), P.ALERT_VC)


def q_vc_count_map(spark, sf):
    return state.vc_count_map(_sensor(spark, sf))


def q_vc_count_running(spark, sf):
    return state.vc_count_running(_sensor(spark, sf))


def q_ttl_event_time(spark, sf):
    return state.ttl_last_value(_sensor(spark, sf), P.TTL_S, P.ALERT_VC)


def q_changelog_sum(spark, sf):
    return bridge.changelog_group_sum(_sensor(spark, sf))


# ---- UDF families ------------------------------------------------------------

def q_udf_java_hash(spark, sf):
    from sensorflow.functions import udfs
    s = _sensor(spark, sf)
    return s.select("seq", "id", udfs.java_hash_any(s, "id").alias("id_hash"),
                    udfs.java_hash_any(s, "vc").alias("vc_hash"),
                    udfs.java_hash_any(s, "seq").alias("seq_hash"))


def q_udaf_weighted_avg(spark, sf):
    from sensorflow.functions import udfs
    prepare(spark)
    sc = T.scores(spark, sf)
    return sc.groupBy("name").agg(_rnd(udfs.weighted_avg(F.col("score"), F.col("weight"))).alias("wavg"))


def q_lateral_cross(spark, sf):
    prepare(spark)
    return joins.lateral_split(T.text_lines(spark, sf), "line").drop("line")


def q_lateral_left(spark, sf):
    prepare(spark)
    return joins.lateral_split(T.text_lines(spark, sf), "line", outer=True).drop("line")


# ---- joins -------------------------------------------------------------------

def q_join_window(spark, sf):
    prepare(spark)
    left, right = T.left_right(spark, sf)
    return joins.window_join(left, right, P.WINDOW_S)


def q_join_interval(spark, sf):
    prepare(spark)
    left, right = T.left_right(spark, sf)
    return joins.interval_join(left, right, P.JOIN_LOWER_S, P.JOIN_UPPER_S)


def q_join_interval_late(spark, sf):
    a = _arrivals(spark, sf)
    flagged = eventtime.late_rows_two_inputs(*[d.drop("t") for d in T.sides(a, "arrival")], P.DELAY_S, ARRIVAL_ORDER)
    ok = flagged.where(~F.col("late"))
    l = ok.where(F.col("side") == "L").select("seq", "id", "ts", "vc")
    r = ok.where(F.col("side") == "R").select("seq", "id", "ts", "vc")
    return joins.interval_join(l, r, P.JOIN_LOWER_S, P.JOIN_UPPER_S)


def q_join_late_sides(spark, sf):
    """The late rows of both inputs of the interval join, with the side they came from."""
    a = _arrivals(spark, sf)
    flagged = eventtime.late_rows_two_inputs(*[d.drop("t") for d in T.sides(a, "arrival")], P.DELAY_S, ARRIVAL_ORDER)
    return flagged.where("late").select("side", "seq", "id", "ts", "vc")


def q_join_connected(spark, sf):
    prepare(spark)
    o = T.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("x"))
    l = T.table(spark, sf, "lineitem").select(F.col("l_orderkey"), F.col("l_returnflag").alias("y"),
                                              F.col("l_linenumber").alias("n"))
    return joins.connect_join(o, l, "id", "l_orderkey").drop("l_orderkey")


def q_broadcast_static(spark, sf):
    s = _sensor(spark, sf)
    data = s.where(~T.is_config()).select("seq", "id", "vc")
    cfg = s.where(T.is_config()).select("seq", F.col("vc").alias("threshold"))
    return joins.static_threshold_alerts(data, cfg)


def q_broadcast_asof(spark, sf):
    s = _sensor(spark, sf)
    data = s.where(~T.is_config()).select("seq", "id", "vc")
    return joins.asof_threshold_alerts(data, T.config_log(spark, sf))


# ---- event time --------------------------------------------------------------

def q_watermark_trace(spark, sf):
    a = _arrivals(spark, sf).select("seq", "arrival", "ts")
    return eventtime.watermark_trace(a, P.DELAY_S, ARRIVAL_ORDER)


def q_watermark_periodic(spark, sf):
    """Late rows under a generator that emits on a tick grid; fewer than with one that emits at every record."""
    a = _arrivals(spark, sf).select("seq", "arrival", "ts")
    r = eventtime.periodic_watermark(a, P.DELAY_S, P.EMIT_S)
    end_ms = (F.col("ts") - F.pmod(F.col("ts"), F.lit(P.WINDOW_S)) + P.WINDOW_S) * 1000
    return r.withColumn("late", F.col("wm_before_ms") >= end_ms - 1)


def q_watermark_idle(spark, sf):
    """Two inputs, even and odd levels; the odd one falls silent at the cut and holds the watermark back no longer."""
    a = _arrivals(spark, sf).select("seq", "arrival", "ts", F.when(F.col("ts") > P.TS_CUT, 0).otherwise(F.col("vc") % 2).alias("input"))
    return eventtime.idle_watermark(a, P.DELAY_S, P.IDLE_S, "input", [0, 1], ARRIVAL_ORDER)


def q_late_side_output(spark, sf):
    a = _arrivals(spark, sf).select("seq", "id", "ts", "vc", "arrival")
    _, late = eventtime.late_split(a, P.WINDOW_S, P.DELAY_S, P.LATENESS_S, ARRIVAL_ORDER)
    return late.select("seq", "id", "ts", "vc", "arrival", "win_start")


def q_late_allowed(spark, sf):
    a = _arrivals(spark, sf).select("seq", "id", "ts", "vc", "arrival")
    return eventtime.allowed_lateness_windows(a, P.WINDOW_S, P.DELAY_S, P.LATENESS_S, ARRIVAL_ORDER, ["id"])


# ---- sources / sinks ---------------------------------------------------------

def q_src_parse_lines(spark, sf):
    prepare(spark)
    return _rows(transforms.parse_sensor(T.lines(spark, sf).select("seq", "value")))


def q_sink_bucketed_files(spark, sf):
    s = _sensor(spark, sf)
    out = file_sinks.write_bucketed_text(s, spark)
    return file_sinks.read_bucket_counts(spark, out)


def q_sink_rolled_files(spark, sf):
    rolling = file_sinks.Rolling(P.FILE_PREFIX, P.FILE_SUFFIX, P.FILE_BYTES, P.FILE_EVERY_S, 86400, "yyyy-MM-dd")
    lines = file_sinks.rolled_lines(_sensor(spark, sf), rolling)
    return file_sinks.read_rolled_files(spark, file_sinks.write_rolled_text(lines, scratch_path(spark, "rolled-text")))


def q_sink_kafka_records(spark, sf):
    s = _sensor(spark, sf)
    return queues.value_records(s.select(T.sensor_line(s).alias("value")), P.TOPIC)


def q_sink_kafka_keyed(spark, sf):
    s = _sensor(spark, sf)
    rec = queues.keyed_records(s.select(T.sensor_line(s).alias("value")), P.TOPIC)
    return rec.select("topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def q_sink_table_insert(spark, sf):
    s = _rows(_sensor(spark, sf))
    name = table_sinks.insert_into_new_table(spark, s, "sensor_sink")
    return spark.table(name)


QUERIES: dict[str, Query] = {
    k[2:]: v for k, v in sorted(globals().items()) if k.startswith("q_") and callable(v)
}
