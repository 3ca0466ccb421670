"""Table sinks: insert a query result into a catalog table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from sensorflow.session import scratch_path


def insert_into_new_table(spark: SparkSession, df: DataFrame, name: str) -> str:
    """CREATE TABLE <name> (schema) USING parquet at a shared location, then
    ``INSERT INTO`` it from ``df``.  Returns the (unique) table name."""
    table = f"{name}_{uuid.uuid4().hex[:8]}"
    location = scratch_path(spark, table)
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet LOCATION '{location}'")
    df.write.insertInto(table)
    return table


def start_table_stream(df: DataFrame, table: str, checkpoint: str, trigger: dict | None = None):
    """Streaming insert: ``writeStream.toTable``."""
    w = df.writeStream.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.toTable(table)
