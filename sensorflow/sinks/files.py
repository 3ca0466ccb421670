"""Row-format file sink with time buckets (hourly directories)."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.operators.scan import Agg, running
from sensorflow.session import remove_path, scratch_path
from sensorflow.sources.tables import sensor_line

BUCKET_FORMAT = "yyyy-MM-dd HH"
RENAMES = 8
# what Spark writes in place of no value, and of these characters, in the name of a folder
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = {c: f"%{c:02X}" for c in [*range(1, 32), *map(ord, "\"#%'*/:=?\\{[]^"), 127]}


def bucketed_lines(df: DataFrame, time_col: str = "t") -> DataFrame:
    """(bucket, value): the text line of each record and its hour bucket."""
    return df.select(F.date_format(F.col(time_col), BUCKET_FORMAT).alias("bucket"),
                     sensor_line(df).alias("value"))


def write_bucketed_text(df: DataFrame, spark: SparkSession, path: str | None = None,
                        max_records_per_file: int = 100_000) -> str:
    """Batch write: one directory per hour bucket, files rolled by row count.

    Rows are dealt by ranges of (bucket, hash): a task writes a few neighbouring buckets whole,
    and a bucket with many rows is written by as many tasks as its share asks for."""
    path = path or scratch_path(spark, "bucketed-text")
    lines = bucketed_lines(df)
    dealt = lines.repartitionByRange("bucket", F.xxhash64("value"))
    (dealt.write.mode("overwrite").partitionBy("bucket")
     .option("maxRecordsPerFile", max_records_per_file).text(path))
    return path


@dataclass(frozen=True)
class Rolling:
    """Names and ends of row files: ``<prefix>-<part>-<number><suffix>``.

    A bucket is a folder of ``bucket_s`` seconds, named by ``bucket_format``.  A file takes the rows of
    one bucket and of ``every_s`` seconds of it (its part), until it holds ``max_bytes``; the line that
    passes the limit is its last."""

    prefix: str = "part"
    suffix: str = ".txt"
    max_bytes: int = 1 << 20
    every_s: int | None = None
    bucket_s: int = 3600
    bucket_format: str = BUCKET_FORMAT


def rolled_lines(df: DataFrame, rolling: Rolling, time_col: str = "ts", order: list[str] | None = None,
                 line: Column | None = None) -> DataFrame:
    """(bucket, file, value): the text line of each record, its bucket and the name of its file.

    A record's file is the number of whole limits in the bytes before it in (bucket, part), a
    running sum in ``order``: the files do not depend on how the rows are dealt, and a bucket with
    a third of all rows is no task's work."""
    value = sensor_line(df) if line is None else line
    at = F.pmod(F.col(time_col), F.lit(rolling.bucket_s))
    part = F.floor(at / rolling.every_s).cast("int") if rolling.every_s else F.lit(0)
    rows = df.select(F.date_format(F.timestamp_seconds(time_col), rolling.bucket_format).alias("bucket"), part.alias("part"),
                     *[F.col(c) for c in (order or [time_col, "seq"])], value.alias("value"))
    rows = rows.withColumn("size", F.octet_length("value") + 1)
    r = running(rows, ["bucket", "part"], order or [time_col, "seq"], [Agg("before", "sum", "size", exclusive=True)])
    number = F.floor(F.coalesce("before", F.lit(0)) / rolling.max_bytes).cast("int")
    name = F.concat(F.lit(f"{rolling.prefix}-"), F.col("part").cast("string"), F.lit("-"), number.cast("string"), F.lit(rolling.suffix))
    return r.select("bucket", name.alias("file"), "value")


def _escaped(value: str | None) -> str:
    return value.translate(ESCAPED) if value else NO_VALUE


def _named_files(staging: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's work on rows (bucket, file, line with its end) that lie file by file: ``staging/bucket=<bucket>/<file>``.
    Gives how many files there are.  A file has its name once it is whole; another attempt puts the same one in its place."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        temp, name, out, n, made = f"{staging}/_{uuid.uuid4().hex}", None, None, 0, set()

        def close() -> None:
            out.close()
            folder = f"{staging}/bucket={_escaped(name[0])}"
            if folder not in made:
                try:
                    os.mkdir(folder)
                except FileExistsError:
                    pass
                made.add(folder)
            os.replace(temp, f"{folder}/{_escaped(name[1])}")

        for b in batches:
            if not b.num_rows:
                continue
            bucket, file, line = b.columns
            runs = [pc.run_end_encode(c) for c in (bucket, file)]
            ends = np.union1d(*(r.run_ends.to_numpy() for r in runs))
            wide = np.int64 if pa.types.is_large_binary(line.type) else np.int32
            _, offsets, data = line.buffers()
            offsets, data = np.frombuffer(offsets, wide)[line.offset:].tolist(), memoryview(data or b"")
            start = 0
            for end in ends.tolist():
                mine = bucket[start].as_py(), file[start].as_py()
                if out is None or mine != name:
                    if out is not None:
                        close()
                    name, out, n = mine, open(temp, "wb"), n + 1
                out.write(data[offsets[start]:offsets[end]])
                start = end
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return work


def write_rolled_text(lines: DataFrame, path: str) -> str:
    """Writes (bucket, file, value) as ``path/bucket=<bucket>/<file>``.

    Files are first written below ``_staging``, which readers pass over.  In a file system that tasks reach by path they get
    their names there (Hadoop starts a ``chmod`` or two for every file it creates in one), and a bucket is put in place
    by one rename.  Elsewhere Spark writes one folder per file, and each file gets its name by a rename: tasks put what they
    commit in place themselves (committer version 2: nothing in ``_staging`` is read before the job has ended);
    ``RENAMES`` files of a bucket are renamed at a time.  A second run with the same rows puts the same files in place."""
    spark = lines.sparkSession
    staging = f"{path}/_staging"
    hadoop = spark._jvm.org.apache.hadoop.fs
    Path = hadoop.Path
    fs = Path(staging).getFileSystem(spark._jsc.hadoopConfiguration())
    named = fs.getUri().getScheme() == "file"
    # all rows of a file go to one task: a file is bounded by its limit
    dealt = lines.repartition("bucket", "file")
    if named:
        remove_path(spark, staging)
        fs.mkdirs(Path(staging))
        (dealt.sortWithinPartitions("bucket", "file")
         .select("bucket", "file", F.concat(F.coalesce("value", F.lit("")), F.lit("\n")).cast("binary").alias("line"))
         .mapInArrow(_named_files(Path(staging).toUri().getPath()), "n bigint").write.format("noop").mode("overwrite").save())
    else:
        (dealt.write.mode("overwrite").partitionBy("bucket", "file")
         .option("maxRecordsPerFile", 0).option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(staging))

    def found(pattern: str):
        return hadoop.FileUtil.stat2Paths(fs.globStatus(Path(pattern)))

    def move(file, to) -> None:
        if not fs.rename(file, to):
            raise RuntimeError(f"could not put {to} in place")

    def put(files, first: int, target: str, anew: bool) -> None:
        for i in range(first, len(files), RENAMES):
            file = files[i]
            to = Path(f"{target}/{file.toString().split('/')[-1 if named else -2].removeprefix('file=')}")
            if not anew:
                fs.delete(to, False)
            move(file, to)

    with ThreadPoolExecutor(RENAMES) as pool:
        for folder in found(f"{staging}/bucket=*"):
            target = Path(f"{path}/{folder.getName()}")
            anew = not fs.exists(target)
            if named and anew:
                move(folder, target)
                continue
            fs.mkdirs(target)
            files = found(f"{folder.toString()}/{'*' if named else 'file=*/part-*'}")
            for done in [pool.submit(put, files, i, target.toString(), anew) for i in range(RENAMES)]:
                done.result()
    remove_path(spark, staging)
    return path


def read_rolled_files(spark: SparkSession, path: str) -> DataFrame:
    """(bucket, file, cnt, n_bytes) of the files that are in place."""
    back = spark.read.schema("value string, bucket string").text(path)
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return back.groupBy("bucket", name.alias("file")).agg(
        F.count(F.lit(1)).alias("cnt"), F.sum(F.octet_length("value") + 1).cast("bigint").alias("n_bytes"))


def start_bucketed_text_stream(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                               max_records_per_file: int = 100_000, salts: int = 4):
    """Streaming write: files finalise per micro-batch (exactly-once via the
    sink's commit log); without ``trigger`` a batch at least every minute."""
    lines = bucketed_lines(df)
    dealt = lines.repartition("bucket", F.pmod(F.xxhash64("value"), F.lit(salts)))
    return (dealt.writeStream.format("text").partitionBy("bucket")
            .option("path", path).option("checkpointLocation", checkpoint)
            .option("maxRecordsPerFile", max_records_per_file)
            .trigger(**(trigger or {"processingTime": "1 minute"})).start())


def read_bucket_counts(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back (bucket from the directory name) and count per bucket."""
    back = spark.read.schema("value string, bucket string").text(path)
    return back.groupBy("bucket").agg(F.count(F.lit(1)).alias("cnt"))
