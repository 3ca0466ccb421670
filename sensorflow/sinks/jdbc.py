"""Relational sink: mini-batched inserts with bounded retries.

Runs inside ``foreachBatch``; each micro-batch is written with JDBC
``batchsize`` rows per round trip.  No database is started by this
library or its tests.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame


def jdbc_batch_writer(url: str, table: str, properties: dict[str, str] | None = None,
                      batch_size: int = 100, max_retries: int = 3, backoff_s: float = 1.0):
    """A ``foreachBatch`` function appending each micro-batch to ``table``."""
    props = {"batchsize": str(batch_size), **(properties or {})}

    def write(batch: DataFrame, batch_id: int) -> None:
        for attempt in range(max_retries + 1):
            try:
                batch.write.mode("append").jdbc(url, table, properties=props)
                return
            except Exception:
                if attempt == max_retries:
                    raise
                time.sleep(backoff_s * (attempt + 1))

    return write
