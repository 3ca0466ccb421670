"""Labelled print sinks."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled(df: DataFrame, label: str) -> DataFrame:
    """Prefix every row with its output label (like ``print("tag")``)."""
    return df.select(F.lit(label).alias("label"), *df.columns)


def print_stream(df: DataFrame, label: str, checkpoint: str, to_stderr: bool = False, trigger: dict | None = None,
                 rows: int = 20):
    """Console sink; the label becomes the first column.  A batch shows its first ``rows`` rows, as the console
    source does; ``to_stderr`` prints them to the error stream."""
    out = labelled(df, label)

    def show(batch: DataFrame, batch_id: int) -> None:
        for r in batch.take(rows):
            print(*r, file=sys.stderr if to_stderr else sys.stdout)

    w = out.writeStream.foreachBatch(show).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()
