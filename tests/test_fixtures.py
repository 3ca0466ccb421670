"""Golden tests: the reference's inline data sets and the outputs worked out
by reading its programs (FIXTURES.md section 2)."""

from pyspark.sql import functions as F

from conftest import sensor_df
from sensorflow.functions.scalar import java_hash, java_split
from sensorflow.functions.udfs import weighted_avg
from sensorflow.operators import (bridge, joins, keyed, state, topn, transforms,
                                  windows)


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()] if cols else [tuple(r) for r in df.collect()]


def test_word_count_words_file(spark):
    lines = spark.createDataFrame([("hello flink",), ("hello world",), ("hello java",)], "line string")
    words = lines.select(F.explode(java_split(F.col("line"), " ")).alias("word"))
    got = dict(rows(keyed.word_count(words)))
    assert got == {"hello": 3, "flink": 1, "world": 1, "java": 1}


def test_map_and_filter(spark):
    df = sensor_df(spark, [("s1", 1, 1), ("s2", 2, 2), ("s3", 3, 3)])
    assert [r[0] for r in rows(transforms.map_project(df, "id").orderBy("id"))] == ["s1", "s2", "s3"]
    f4 = sensor_df(spark, [("s1", 1, 1), ("s1", 11, 11), ("s2", 2, 2), ("s3", 3, 3)])
    assert rows(transforms.filter_eq(f4, "id", "s1").orderBy("seq"), "ts") == [(1,), (11,)]


def test_flatmap_conditional(spark):
    f4 = sensor_df(spark, [("s1", 1, 1), ("s1", 11, 11), ("s2", 2, 2), ("s3", 3, 3)])
    out = transforms.flatmap_conditional(f4).orderBy("seq", "pos")
    assert [r[0] for r in rows(out, "value")] == ["1", "11", "2", "2"]


def test_running_max_keeps_first_fields_and_max_by(spark):
    f4 = sensor_df(spark, [("s1", 1, 1), ("s1", 11, 11), ("s2", 2, 2), ("s3", 3, 3)])
    mx = keyed.running_extreme(f4, "max").orderBy("seq")
    assert rows(mx, "id", "ts", "vc")[1] == ("s1", 1, 11)
    mb = keyed.running_extreme_by(f4, "max_by").orderBy("seq")
    assert rows(mb, "id", "ts", "vc") == [("s1", 1, 1), ("s1", 11, 11), ("s2", 2, 2), ("s3", 3, 3)]


def test_running_reduce(spark):
    df = sensor_df(spark, [("s1", 1, 1), ("s1", 11, 11), ("s1", 21, 21), ("s2", 2, 2), ("s3", 3, 3)])
    got = rows(keyed.running_reduce(df).orderBy("seq"), "id", "ts", "vc")
    assert got == [("s1", 1, 1), ("s1", 11, 12), ("s1", 21, 33), ("s2", 2, 2), ("s3", 3, 3)]


def test_union_three_inputs(spark):
    a = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    b = spark.createDataFrame([(11,), (22,), (33,)], "v int")
    c = spark.createDataFrame([("111",), ("222",), ("333",)], "v string").select(F.col("v").cast("int").alias("v"))
    assert transforms.union_all(a, b, c).count() == 9


def test_connect_keyed(spark):
    l = spark.createDataFrame([(1, "a1"), (1, "a2"), (2, "b"), (3, "c")], "id int, x string")
    r = spark.createDataFrame([(1, "aa1", 1), (1, "aa2", 2), (2, "bb", 1), (3, "cc", 1)], "rid int, y string, n int")
    assert joins.connect_join(l, r, "id", "rid").count() == 6


def _join_fixture(spark):
    l = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "id string, ts bigint")
    r = spark.createDataFrame([("a", 1, 1), ("a", 11, 1), ("b", 2, 1), ("b", 12, 1), ("c", 14, 1), ("d", 15, 1)],
                              "id string, ts bigint, vc int")
    return l, r


def test_window_join_10s(spark):
    l, r = _join_fixture(spark)
    got = sorted(rows(joins.window_join(l, r, 10), "id", "l_ts", "r_ts"))
    assert got == [("a", 1, 1), ("a", 2, 1), ("b", 3, 2)]


def test_interval_join_2s(spark):
    l, r = _join_fixture(spark)
    got = sorted(rows(joins.interval_join(l, r, -2, 2), "id", "l_ts", "r_ts"))
    assert got == [("a", 1, 1), ("a", 2, 1), ("b", 3, 2)]


def test_interval_join_bounds_inclusive(spark):
    l = spark.createDataFrame([("k", 10)], "id string, ts bigint")
    r = spark.createDataFrame([("k", 8), ("k", 12), ("k", 7), ("k", 13)], "id string, ts bigint")
    assert sorted(rows(joins.interval_join(l, r, -2, 2), "r_ts")) == [(8,), (12,)]


def test_table_fixture(spark):
    df = sensor_df(spark, [("s1", 1, 1), ("s1", 2, 2), ("s2", 2, 2), ("s3", 3, 3), ("s3", 4, 4)])
    df.createOrReplaceTempView("sensor_t")
    assert sorted(rows(spark.sql("select id, ts, vc from sensor_t where ts > 2"))) == [("s3", 3, 3), ("s3", 4, 4)]
    assert dict(rows(keyed.group_sum(df))) == {"s1": 3, "s2": 2, "s3": 7}
    cl = rows(bridge.changelog_group_sum(df).orderBy("seq", "pos"), "op", "id", "sum_vc")
    assert cl == [("+I", "s1", 1), ("-U", "s1", 1), ("+U", "s1", 3), ("+I", "s2", 2),
                  ("+I", "s3", 3), ("-U", "s3", 3), ("+U", "s3", 7)]
    h = dict(rows(df.select("id", java_hash("id", df.schema["id"].dataType)).distinct()))
    assert h == {"s1": 3614, "s2": 3615, "s3": 3616}


def test_weighted_avg(spark):
    df = spark.createDataFrame([("zs", 80, 3), ("zs", 90, 4), ("zs", 95, 4), ("ls", 75, 4), ("ls", 65, 4),
                                ("ls", 85, 4)], "name string, score int, weight int")
    got = {k: round(v, 6) for k, v in rows(df.groupBy("name").agg(weighted_avg(F.col("score"), F.col("weight"))))}
    assert got == {"zs": 89.090909, "ls": 75.0}


def test_top2_table_aggregate(spark):
    nums = spark.createDataFrame([(n,) for n in [3, 6, 12, 5, 8, 9, 4]], "vc int")
    assert sorted(rows(topn.top2_table_aggregate(nums), "value", "rank")) == [(9, 2), (12, 1)]
    neg = spark.createDataFrame([(0,), (-3,)], "vc int")
    assert topn.top2_table_aggregate(neg).count() == 0
    dup = spark.createDataFrame([(7,), (7,), (1,)], "vc int")
    assert sorted(rows(topn.top2_table_aggregate(dup), "value", "rank")) == [(7, 1), (7, 2)]


def test_lateral_split(spark):
    df = spark.createDataFrame([("hello flink",), ("hello world hi",), ("hello java",)], "words string")
    out = joins.lateral_split(df, "words")
    assert out.count() == 7
    assert ("hello world hi", "hi", 2) in rows(out, "words", "word", "length")
    left = joins.lateral_split(spark.createDataFrame([("  ",), ("a",)], "words string"), "words", outer=True)
    assert sorted(rows(left, "word"), key=str) == [("a",), (None,)]


def test_delta_alert_first_reading(spark):
    df = sensor_df(spark, [("s1", 1, 11), ("s1", 2, 15), ("s1", 3, 30)])
    got = rows(state.delta_alert(df).orderBy("seq"), "vc", "prev_vc")
    assert got == [(11, 0), (30, 15)]


def test_running_top3_list_state(spark):
    df = sensor_df(spark, [("s1", i, v) for i, v in enumerate([5, 1, 9, 7, 3])])
    got = [r[0] for r in rows(topn.running_topk(df, 3).orderBy("seq"), "top")]
    assert got == [[5], [5, 1], [9, 5, 1], [9, 7, 5], [9, 7, 5]]


def test_vc_count_map(spark):
    df = sensor_df(spark, [("s1", 1, 5), ("s1", 2, 5), ("s1", 3, 6)])
    assert sorted(rows(state.vc_count_map(df))) == [("s1", 5, 2), ("s1", 6, 1)]
    assert [r[0] for r in rows(state.vc_count_running(df).orderBy("seq"), "n")] == [1, 2, 1]


def test_generic_table_aggregate_top2_matches_row_number(spark):
    from sensorflow.functions import table_agg as TA
    nums = spark.createDataFrame([("k", n) for n in [3, 6, 12, 5, 8, 9, 4]] + [("j", 7), ("j", 7), ("j", -1)],
                                 "g string, num int").repartition(3)
    out = TA.table_aggregate(nums, ["g"], ["num"], TA.top2_create, TA.top2_accumulate, TA.top2_merge,
                             TA.top2_emit, "g string, value int, rank int")
    assert sorted(rows(out)) == [("j", 7, 1), ("j", 7, 2), ("k", 9, 2), ("k", 12, 1)]
