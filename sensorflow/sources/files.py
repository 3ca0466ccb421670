"""File sources: bounded text files and text folders read as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def text_file(spark: SparkSession, path: str) -> DataFrame:
    """One row per line (``value string``); lines end at ``\\n`` only."""
    return spark.read.option("lineSep", "\n").text(path)


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New files of a folder as a stream of lines (no watermark)."""
    r = spark.readStream.format("text").option("lineSep", "\n")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)
