"""The two-level running scan: exact types, ties, nulls, hot keys; building it runs no job."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sensorflow.operators.scan import BUCKET, Agg, running, with_buckets

BIG = 2 ** 53
KINDS = [Agg("s", "sum", "v"), Agg("n", "count"), Agg("mx", "max", "v"), Agg("mn", "min", "v"), Agg("f", "first", "v"),
         Agg("l", "last", "v"), Agg("xb", "max_by", "seq", by="v"), Agg("nb", "min_by", "seq", by="v"), Agg("t", "topk", "v", k=3),
         Agg("ls", "last", "v", exclusive=True), Agg("ss", "sum", "v", exclusive=True), Agg("te", "topk", "v", k=2, exclusive=True)]


def brute(rows):
    """rows (k, seq, v) -> {(k, seq): results of KINDS}"""
    out, seen = {}, {}
    for k, seq, v in sorted(rows, key=lambda r: r[1]):
        past = seen.setdefault(k, [])
        now = past + [(seq, v)]
        vals, before = [x for _, x in now if x is not None], [x for _, x in past if x is not None]
        best = [(x, -s) for s, x in now if x is not None]
        least = [(x, s) for s, x in now if x is not None]
        out[k, seq] = (sum(vals) if vals else None, len(now), max(vals, default=None), min(vals, default=None),
                       vals[0] if vals else None, vals[-1] if vals else None, -max(best)[1] if best else None,
                       min(least)[1] if least else None, sorted(vals, reverse=True)[:3], before[-1] if before else None,
                       sum(before) if before else None, sorted(before, reverse=True)[:2])
        past.append((seq, v))
    return out


def check(spark, rows, kind, buckets):
    df = spark.createDataFrame(rows, f"k string, seq bigint, v {kind}")
    got = {(r.k, r.seq): tuple(r[3:]) for r in running(df, ["k"], ["seq"], KINDS, buckets=buckets).collect()}
    want = brute(rows)
    assert got.keys() == want.keys()
    for key, w in want.items():
        assert tuple(list(x) if isinstance(x, (list, tuple)) else x for x in got[key]) == w, key


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_bigints_around_2_53_with_nulls_and_ties(spark, buckets):
    rnd = random.Random(buckets)
    rows = [(rnd.choice(["hot", "hot", "a", None]), i * 3, rnd.choice([None, BIG + rnd.randint(0, 5), BIG + rnd.randint(0, 5)]))
            for i in range(400)]
    check(spark, rows, "bigint", buckets)


def test_decimals(spark):
    check(spark, [("a", i, Decimal(i * 7 % 5) / 10 if i % 4 else None) for i in range(60)], "decimal(20,1)", 5)


def test_strings_and_dates_have_extremes(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "z"), ("a", 3, "y")], "k string, seq bigint, v string")
    out = running(df, ["k"], ["seq"], [Agg("m", "max", "v"), Agg("f", "first", "v")], buckets=2).orderBy("seq").collect()
    assert [r.m for r in out] == ["x", "z", "z"] and {r.f for r in out} == {"x"}
    dates = df.withColumn("v", F.date_add(F.lit("2024-01-01").cast("date"), F.col("seq").cast("int")))
    assert running(dates, ["k"], ["v"], [Agg("m", "min", "v")]).where("m != date'2024-01-02'").count() == 0


def test_overflow_raises(spark):
    df = spark.createDataFrame([("a", 1, 2 ** 63 - 1), ("a", 2, 1)], "k string, seq bigint, v bigint")
    with pytest.raises(Exception, match="(?i)overflow"):
        running(df, ["k"], ["seq"], [Agg("s", "sum", "v")], buckets=1).collect()


def test_without_keys_with_null_places_and_without_rows(spark):
    df = spark.createDataFrame([(None, 5), (3, 1), (1, 2), (2, 4)], "seq bigint, v int")
    out = running(df, [], ["seq"], [Agg("s", "sum", "v")], buckets=3).collect()
    assert {r.seq: r.s for r in out} == {None: 5, 1: 7, 2: 11, 3: 12}
    assert running(df.limit(0), [], ["seq"], [Agg("s", "sum", "v")]).count() == 0


def test_building_a_scan_runs_no_job_and_has_no_python(spark):
    df = spark.range(1000).selectExpr("id AS seq", "id % 3 AS k", "id AS v")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    try:
        plan = running(df, ["k"], ["seq"], KINDS)._jdf.queryExecution().executedPlan().toString()
        assert not tracker.getJobIdsForGroup("build")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "Python" not in plan and "Pandas" not in plan and "Existing" not in plan


def test_order_must_be_a_number_or_time(spark):
    df = spark.createDataFrame([("a", 1)], "seq string, v int")
    with pytest.raises(ValueError):
        running(df, [], ["seq"], [Agg("s", "sum", "v")])


@pytest.mark.parametrize("far", [10 ** 12, -10 ** 12])
def test_a_far_off_place_widens_no_other_bucket(spark, far):
    """A sentinel place must not push the rows of a hot key into one bucket."""
    rows = spark.range(20_000).selectExpr("id AS seq", "IF(id % 3 = 0, 'hot', concat('k', id % 50)) AS k", "id AS v")
    rows = rows.union(spark.createDataFrame([(far, "hot", 1)], "seq bigint, k string, v bigint"))
    n = with_buckets(rows, ["k"], ["seq"], 256).groupBy(BUCKET).agg(F.count("*").alias("n")).orderBy(F.desc("n")).collect()
    assert n[0].n <= 2 * 20_000 / 256
    got = running(rows, ["k"], ["seq"], [Agg("s", "sum", "v")], buckets=256).where("k = 'hot'").agg(F.max("s")).first()[0]
    assert got >= sum(range(0, 20_000, 3))


def test_buckets_of_bursts_and_single_places(spark):
    """All rows at one place, one row, no rows, rows without a place: every row is in some bucket and the sums are right."""
    for places in ([5] * 300, [7], [], [None, None, 3], [1] * 200 + [2] * 200 + [10 ** 9]):
        df = spark.createDataFrame([("a", x, i, 1) for i, x in enumerate(places)], "k string, t bigint, i bigint, v bigint")
        got = [r.s for r in running(df, ["k"], ["t", "i"], [Agg("s", "sum", "v")], buckets=64).orderBy("t", "i").collect()]
        assert got == list(range(1, len(places) + 1))


def test_both_steps_use_the_same_cuts(spark):
    """The cuts are approximate, so states and rows must read one and the same result of one subquery."""
    df = spark.range(0, 5000, 1, 6).selectExpr("id AS seq", "id % 7 AS k", "id AS v")
    r = running(df, ["k"], ["seq"], [Agg("s", "sum", "v"), Agg("t", "topk", "v", k=2)])
    assert r.agg(F.sum("s")).first()[0] > 0
    r.collect()
    plan = r._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedSubquery") >= 1 and plan.count("+- Subquery subquery#") <= 1
