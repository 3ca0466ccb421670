"""One key holding a third of all rows: results stay exact and the hot key
is spread over several tasks."""

import duckdb
from pyspark.sql import functions as F

from sensorflow.operators import bridge, keyed, windows
from sensorflow.operators.scan import Agg, running
from sensorflow.sources.tables import sensor

SF = "/root/testdata/sf0.01"
HOT_SQL = (f"WITH sensor AS (SELECT event_id AS seq, CASE WHEN event_id % 3 = 0 THEN 'hot' "
           f"ELSE 's' || CAST(user_id AS VARCHAR) END AS id, CAST(floor(epoch(ts)) AS BIGINT) AS ts, "
           f"CAST(floor(value) AS INTEGER) AS vc FROM read_parquet('{SF}/events.parquet')) ")
W = "PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _hot(spark):
    s = sensor(spark, SF)
    return s.withColumn("id", F.when(F.col("seq") % 3 == 0, F.lit("hot")).otherwise(F.col("id")))


def _same(df, sql, cols):
    got = sorted(tuple(r) for r in df.select(*cols).collect())
    exp = sorted(tuple(r) for r in duckdb.sql(HOT_SQL + sql).fetchall())
    return got == exp


def test_hot_key_spans_partitions(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        r = running(_hot(spark).select("seq", "id", "vc"), ["id"], ["seq"], [Agg("s", "sum", "vc")], buckets=64)
        per = r.where("id = 'hot'").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max("s")).collect()
        assert len(per) >= 6 and max(x.n for x in per) < 0.4 * sum(x.n for x in per)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hot_key_running_reduce(spark):
    r = keyed.running_reduce(_hot(spark))
    assert _same(r, f"SELECT seq, id, ts, CAST(sum(vc) OVER ({W}) AS BIGINT) FROM sensor", ["seq", "id", "ts", "vc"])


def test_hot_key_changelog(spark):
    r = bridge.changelog_group_sum(_hot(spark)).where("id = 'hot'")
    n = r.count()
    hot_rows = _hot(spark).where("id = 'hot'").count()
    assert n == 2 * hot_rows - 1
    last = r.orderBy(F.desc("seq"), F.desc("pos")).first()["sum_vc"]
    assert last == duckdb.sql(HOT_SQL + "SELECT sum(vc) FROM sensor WHERE id = 'hot'").fetchall()[0][0]


def test_hot_key_sessions(spark):
    r = windows.sessions(_hot(spark).select("seq", "id", "ts", "vc"), ["id"], gap_s=600)
    sql = ("SELECT id, min(ts), max(ts) + 600, count(*), CAST(sum(vc) AS BIGINT) FROM (SELECT *, sum(CASE WHEN p IS NULL "
           "OR ts - p > 600 THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING "
           "AND CURRENT ROW) AS sno FROM (SELECT *, lag(ts) OVER (PARTITION BY id ORDER BY ts, seq) AS p FROM sensor)) "
           "GROUP BY id, sno")
    assert _same(r, sql, ["id", "win_start", "win_end", "cnt", "vc_sum"])


def test_hot_key_count_windows(spark):
    r = windows.count_sliding(_hot(spark).select("seq", "id", "ts", "vc"), 5, 2, ["id"])
    sql = ("SELECT f.id, f.rn, count(*), CAST(sum(r.vc) AS BIGINT) FROM (SELECT id, rn FROM "
           "(SELECT id, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn FROM sensor) WHERE rn % 2 = 0) f "
           "JOIN (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn FROM sensor) r "
           "ON r.id = f.id AND r.rn BETWEEN f.rn - 4 AND f.rn GROUP BY f.id, f.rn")
    assert _same(r, sql, ["id", "fire_no", "cnt", "vc_sum"])
