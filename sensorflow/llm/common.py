"""Helpers shared by the corpus operators: table reads, written tables, word rules."""

from __future__ import annotations

import tempfile
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from sensorflow.session import ship_package

# Fixed by the contracts: white space that splits words and that exact dedup deletes.
SPACE_CHARS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder of the session.

    Only a local master may do without that setting; a cluster without a shared
    folder is an error, not a silent write to one machine's disk.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="sensorflow-llm-"))
        root = sc.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as parquet to the shared folder and read again.

    Cuts the lineage in a way that survives the loss of any executor, and lets
    later steps reuse the rows without computing them twice.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path).withMetadata(df.columns[0], {"path": path})


def stored_path(df: DataFrame) -> str:
    return df.schema[0].metadata["path"]


def drop_stored(df: DataFrame) -> None:
    """Delete a table that ``stored`` wrote and nothing needs any more."""
    drop_path(df.sparkSession, stored_path(df))


def drop_path(spark: SparkSession, folder: str) -> None:
    """Delete a folder below the scratch folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


@F.pandas_udf(LongType())
def word_count(text: pd.Series) -> pd.Series:
    """Number of ``[^\\x20\\x09-\\x0D]+`` words of UTF-8 bytes; null: 0."""
    return text.map(lambda t: len(t.split()) if t is not None else 0).astype("int64")
