import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from sensorflow.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()


def sensor_df(spark, rows, with_seq=True):
    """Inline sensor rows (id, ts, vc) in arrival order -> seq, id, ts, vc, t."""
    from pyspark.sql import functions as F
    data = [(i, r[0], int(r[1]), int(r[2])) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "seq bigint, id string, ts bigint, vc int")
    return df.withColumn("t", F.timestamp_seconds("ts"))
