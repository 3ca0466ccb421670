"""Table <-> stream bridging: the changelog of an updating aggregate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.operators.scan import Agg, dealt, running


def changelog_group_sum(df: DataFrame, key: str = "id", col: str = "vc",
                        order: list[str] | None = None, scan: Callable = running) -> DataFrame:
    """Changelog of ``select key, sum(col) group by key`` fed row by row:
    the first row of a key inserts (+I); every later row retracts the old
    sum (-U) and adds the new one (+U).  ``pos`` orders the rows of one
    input record."""
    r = scan(df.select("seq", key, col, *dealt(df)), [key], order or ["seq"],
             [Agg("new_sum", "sum", col), Agg("old_sum", "sum", col, exclusive=True)])
    ops = F.when(F.col("old_sum").isNull(),
                 F.array(F.struct(F.lit(0).alias("pos"), F.lit("+I").alias("op"), F.col("new_sum").alias("sum_vc"))))\
        .otherwise(F.array(F.struct(F.lit(0).alias("pos"), F.lit("-U").alias("op"), F.col("old_sum").alias("sum_vc")),
                           F.struct(F.lit(1).alias("pos"), F.lit("+U").alias("op"), F.col("new_sum").alias("sum_vc"))))
    return r.select("seq", key, F.inline(ops))
