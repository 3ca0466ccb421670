"""Readers for the parquet tables and the sensor-shaped views derived from them.

Every view is a lazy projection over a parquet scan, so Catalyst prunes
columns and pushes filters into the scan of whatever query uses it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.scalar import epoch_seconds, java_split

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Fixed values of the derived late-data recipe (arrival = ts + (seq*7919) % 1800).
ARRIVAL_MULTIPLIER = 7919
ARRIVAL_SPREAD_S = 1800


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sensor_from_events(events: DataFrame) -> DataFrame:
    """events -> sensor(seq, id, kind, ts, vc, t).

    ``ts`` is whole epoch seconds of the zone-less event time, ``t`` the
    matching TIMESTAMP used for windows and watermarks.
    """
    return (events
            .select(F.col("event_id").alias("seq"),
                    F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("id"),
                    F.col("event_type").alias("kind"),
                    epoch_seconds(F.col("ts")).alias("ts"),
                    F.floor("value").cast("int").alias("vc"))
            .withColumn("t", F.timestamp_seconds("ts")))


def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor_from_events(table(spark, sf_dir, "events"))


def arrival_col(ts: Column | str = "ts", seq: Column | str = "seq") -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    seq = F.col(seq) if isinstance(seq, str) else seq
    return ts + F.pmod(seq * F.lit(ARRIVAL_MULTIPLIER), F.lit(ARRIVAL_SPREAD_S))


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sensor + ``arrival`` (epoch s) and ``at`` (timestamp): the order rows reach us."""
    return (sensor(spark, sf_dir)
            .withColumn("arrival", arrival_col())
            .withColumn("at", F.timestamp_seconds("arrival")))


def sensor_line(df: DataFrame) -> Column:
    return F.concat_ws(",", F.col("id"), F.col("ts").cast("string"), F.col("vc").cast("string"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines ``id,ts,vc`` with their arrival order."""
    a = arrivals(spark, sf_dir)
    return a.select("seq", "arrival", sensor_line(a).alias("value"))


def left_right(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two streams for time joins: see :func:`sides`."""
    return sides(sensor(spark, sf_dir))


# Which side of a two-input operator a kind of event is on; every kind, also an unknown or missing one, is on one.
LEFT_KINDS = ("view", "click", "signup")


def is_left() -> Column:
    return F.coalesce(F.col("kind").isin(*LEFT_KINDS), F.lit(False))


def is_config() -> Column:
    """Whether an event updates the threshold; one without a kind is data."""
    return F.col("kind").eqNullSafe("error")


def sides(s: DataFrame, *more: str) -> tuple[DataFrame, DataFrame]:
    """(left, right) rows of a sensor view: views, clicks and sign-ups on the left, all others on the right."""
    cols = ["seq", "id", "ts", "vc", "t", *more]
    return s.where(is_left()).select(*cols), s.where(~is_left()).select(*cols)


def config_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold updates: every ``error`` row sets threshold = its vc."""
    s = sensor(spark, sf_dir)
    return s.where(is_config()).select("seq", F.col("vc").alias("threshold"))


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents.text cut into lines as a text-file reader would (doc_id, line_no, line)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", F.posexplode(F.split(F.col("text"), "\n", -1)).alias("line_no", "line"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Just the words of every line (no positions): the lean input of word counts."""
    d = table(spark, sf_dir, "documents").select("text")
    lines_ = d.select(F.explode(F.split(F.col("text"), "\n", -1)).alias("line"))
    return lines_.select(F.explode(java_split(F.col("line"), " ")).alias("word"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, score, weight) rows for the weighted-average UDAF."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_returnflag").alias("name"),
                     F.col("l_extendedprice").cast("bigint").alias("score"),
                     F.col("l_quantity").cast("bigint").alias("weight"))
