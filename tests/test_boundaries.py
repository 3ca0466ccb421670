"""Boundary cases (FIXTURES.md section 3) and the semantic-difference list."""

from pyspark.sql import functions as F

from conftest import sensor_df
from sensorflow.functions.scalar import java_split
from sensorflow.operators import distribution, eventtime, windows
from sensorflow.operators.scan import Agg, running


def test_window_assignment_10s(spark):
    df = sensor_df(spark, [("s1", 13, 1), ("s1", 27, 1)])
    got = sorted(r[0] for r in windows.tumbling(df, 10, ["id"]).select("win_start").collect())
    assert got == [10, 20]


def test_late_fire_rules(spark):
    # delay 3 s, window [0,10): a row at 13 s makes the watermark 9999 ms -> window fires;
    # a following row at 5 s is then a re-fire (lateness 2 s) ...
    df = sensor_df(spark, [("s1", 1, 1), ("s1", 13, 1), ("s1", 5, 1)]).withColumn("arrival", F.col("seq"))
    c = eventtime.classify_window_lateness(df, 10, 3, 2, ["arrival", "seq"]).orderBy("seq")
    assert [r[0] for r in c.select("status").collect()] == ["on_time", "on_time", "refire"]
    # ... and after 15 s (wm 11999 >= 9999 + 2000) the window is gone: side output
    df2 = sensor_df(spark, [("s1", 1, 1), ("s1", 15, 1), ("s1", 5, 1)]).withColumn("arrival", F.col("seq"))
    c2 = eventtime.classify_window_lateness(df2, 10, 3, 2, ["arrival", "seq"]).orderBy("seq")
    assert [r[0] for r in c2.select("status").collect()] == ["on_time", "on_time", "late"]


def test_watermark_trace_values(spark):
    df = sensor_df(spark, [("s1", 8, 1), ("s1", 9, 1)]).withColumn("arrival", F.col("seq"))
    tr = eventtime.watermark_trace(df, 3, ["arrival", "seq"]).orderBy("seq")
    assert [r[0] for r in tr.select("wm_after_ms").collect()] == [4999, 5999]
    assert tr.first()["wm_before_ms"] == -(2 ** 63)


def test_count_window_sliding_first_output_at_second_record(spark):
    df = sensor_df(spark, [("s1", i, i) for i in range(1, 8)])
    out = windows.count_sliding(df, 5, 2, ["id"]).orderBy("fire_no")
    got = [(r["fire_no"], r["cnt"]) for r in out.collect()]
    assert got == [(2, 2), (4, 4), (6, 5)]


def test_count_window_tumbling_tail_never_fires(spark):
    df = sensor_df(spark, [("s1", i, 1) for i in range(12)])
    assert windows.count_tumbling(df, 5, ["id"]).count() == 2


def test_sessions_touching_merge(spark):
    df = sensor_df(spark, [("s1", 0, 1), ("s1", 5, 1), ("s1", 11, 1)])
    out = windows.sessions(df, ["id"], gap_s=5).orderBy("win_start")
    assert [(r["win_start"], r["win_end"], r["cnt"]) for r in out.collect()] == [(0, 10, 2), (11, 16, 1)]


def test_custom_partitioner_key_3(spark):
    df = spark.createDataFrame([("3",), ("4",)], "k string")
    out = distribution.custom(df, 2, F.col("k")).select("k", F.spark_partition_id().alias("p"))
    assert dict((r[0], r[1]) for r in out.collect()) == {"3": 1, "4": 0}


def test_odd_filter_negative(spark):
    df = spark.createDataFrame([(-3,), (3,), (4,)], "v int")
    assert df.where(F.col("v") % 2 == 1).count() == 1
    assert df.where(F.col("v") % 2 == 0).count() == 1


def test_java_split_rules(spark):
    df = spark.createDataFrame([("a b  ",), ("",), ("   ",), (" a",)], "s string")
    got = [r[0] for r in df.select(java_split("s", " ")).collect()]
    assert got == [["a", "b"], [""], [], ["", "a"]]


def test_scan_hot_key_across_partitions(spark):
    """One key holding every row is split over many partitions; results equal the
    single-task window result."""
    from pyspark.sql import Window
    n = 3000
    df = spark.range(n).select(F.col("id").alias("seq"), F.lit("hot").alias("k"),
                               (F.col("id") % 17).cast("int").alias("v"))
    r = running(df, ["k"], ["seq"], [Agg("s", "sum", "v"), Agg("m", "max_by", "seq", by="v"),
                                     Agg("p", "last", "v", exclusive=True)], buckets=11)
    w = Window.partitionBy("k").orderBy("seq")
    ref = df.select("*", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
                    F.max_by("seq", F.struct("v", -F.col("seq"))).over(
                        w.rowsBetween(Window.unboundedPreceding, 0)).alias("m"),
                    F.lag("v").over(w).alias("p"))
    assert r.exceptAll(ref).count() == 0 and ref.exceptAll(r).count() == 0


def test_scan_plan_has_no_single_partition_exchange(spark):
    df = spark.range(1000).select(F.col("id").alias("seq"), (F.col("id") % 3).alias("k"),
                                  F.col("id").alias("v"))
    r = running(df, ["k"], ["seq"], [Agg("s", "sum", "v")])
    plan = r._jdf.queryExecution().executedPlan().toString()
    # the only single-partition step adds up partial quantiles of the order
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            assert "partial_percentile(" in lines[i + 1]


def test_scan_all_kinds_across_batches_and_partitions(spark):
    """Small Arrow batches force the in-partition carry between batches as well
    as the cross-partition carry; every aggregate kind must equal the
    single-task window result."""
    from pyspark.sql import Window
    prev = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        df = spark.range(2000).select(F.col("id").alias("seq"),
                                      F.when(F.col("id") % 3 == 0, F.lit("hot"))
                                      .otherwise((F.col("id") % 7).cast("string")).alias("k"),
                                      ((F.col("id") * 7919) % 101).cast("int").alias("v"))
        aggs = [Agg("s", "sum", "v"), Agg("n", "count"), Agg("mx", "max", "v"), Agg("mn", "min", "v"),
                Agg("f", "first", "seq"), Agg("p", "last", "v", exclusive=True),
                Agg("mb", "max_by", "seq", by="v"), Agg("nb", "min_by", "seq", by="v"),
                Agg("t3", "topk", "v", k=3), Agg("ps", "sum", "v", exclusive=True)]
        r = running(df, ["k"], ["seq"], aggs, buckets=9)
        w = Window.partitionBy("k").orderBy("seq")
        wr = w.rowsBetween(Window.unboundedPreceding, 0)
        ref = df.select("*", F.sum("v").over(wr).alias("s"), F.count("*").over(wr).alias("n"),
                        F.max("v").over(wr).alias("mx"), F.min("v").over(wr).alias("mn"),
                        F.first("seq").over(wr).alias("f"), F.lag("v").over(w).alias("p"),
                        F.max_by("seq", F.struct("v", -F.col("seq"))).over(wr).alias("mb"),
                        F.min_by("seq", F.struct("v", "seq")).over(wr).alias("nb"),
                        F.slice(F.sort_array(F.collect_list("v").over(wr), False), 1, 3).alias("t3"),
                        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("ps"))
        assert r.exceptAll(ref).count() == 0 and ref.exceptAll(r).count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", prev)
