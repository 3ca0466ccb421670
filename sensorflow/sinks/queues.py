"""Message-queue (Kafka) records and connector options.

The Kafka connector jar is not part of the local test image, so the
read/write helpers are exercised only up to building the records and
options; on a cluster with the connector they run as is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.scalar import java_split


def value_records(df: DataFrame, topic: str, value_col: str = "value") -> DataFrame:
    """Value-only records: (topic, value)."""
    return df.select(F.lit(topic).alias("topic"), F.col(value_col).cast("string").alias("value"))


def keyed_records(df: DataFrame, topic: str, value_col: str = "value") -> DataFrame:
    """Key = first comma-separated field, value = whole line, both UTF-8 bytes."""
    v = F.col(value_col).cast("string")
    return df.select(F.lit(topic).alias("topic"),
                     F.encode(java_split(v, ",")[0], "UTF-8").alias("key"),
                     F.encode(v, "UTF-8").alias("value"))


def source_options(brokers: str, topic: str, group_id: str | None = None,
                   starting: str = "latest", read_committed: bool = False) -> dict[str, str]:
    """Options for ``readStream.format('kafka')``.  ``starting`` is
    'earliest' / 'latest' or a JSON offsets spec; with a group id the
    committed offsets of that group are used by the broker-side consumer."""
    opts = {"kafka.bootstrap.servers": brokers, "subscribe": topic, "startingOffsets": starting}
    if group_id:
        opts["kafka.group.id"] = group_id
    if read_committed:
        opts["kafka.isolation.level"] = "read_committed"
    return opts


def sink_options(brokers: str, topic: str | None = None) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": brokers}
    if topic:
        opts["topic"] = topic
    return opts


def read_values(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Stream of message values decoded as strings (plus Kafka's timestamp)."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(F.col("value").cast("string").alias("value"), F.col("timestamp"))


def write_stream(records: DataFrame, options: dict[str, str], checkpoint: str):
    """At-least-once queue sink (Spark's Kafka sink); pair it with an idempotent
    consumer.  Exactly-once output goes through the file sink or a
    batch-id-keyed ``foreachBatch`` (see ``exactly_once_pipeline``)."""
    return (records.writeStream.format("kafka").options(**options)
            .option("checkpointLocation", checkpoint).start())
