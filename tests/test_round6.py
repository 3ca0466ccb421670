"""Row files that tasks write themselves."""

import os

from pyspark.sql import functions as F

from sensorflow.session import scratch_path
from sensorflow.sinks import files


def local(spark, name):
    return scratch_path(spark, name).removeprefix("file:")


def in_place(path):
    return {b: {f: open(f"{path}/{b}/{f}").read() for f in os.listdir(f"{path}/{b}")} for b in os.listdir(path) if b.startswith("bucket=")}


def test_tasks_write_row_files_without_a_call_of_hadoop_for_each(spark, monkeypatch):
    """Files that Hadoop creates have a checksum file beside them, and cost the start of two processes each."""
    df = spark.range(400).selectExpr("id AS seq", "id * 60 AS ts")
    lines = files.rolled_lines(df, files.Rolling("a=b, %c", ".txt", max_bytes=100), line=F.format_string("%019d", "seq"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # files that lie in several batches
    try:
        path = files.write_rolled_text(lines, local(spark, "rolled"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = in_place(path)
    assert len(got) == 7 and sum(len(f) for f in got.values()) == 80
    assert sorted(int(line) for fs in got.values() for text in fs.values() for line in text.splitlines()) == list(range(400))
    for r in lines.groupBy("bucket", "file").agg(F.sort_array(F.collect_list("value")).alias("v")).collect():
        name = r.file.replace("%", "%25").replace("=", "%3D")
        assert sorted(got[f"bucket={r.bucket}"][name].splitlines()) == r.v
    # again, with a file too much in place: the same files are put over those there
    files.write_rolled_text(lines.where("bucket < '1970-01-01 03'"), path)
    assert {b: set(f for f in fs if not f.endswith(".crc")) for b, fs in in_place(path).items()} == {b: set(fs) for b, fs in got.items()}


def test_names_are_escaped_as_spark_escapes_them(spark):
    odd = "".join(map(chr, range(1, 128)))
    rows = [(None, "x", "1"), ("", "y", None), (odd[:60], odd[60:], "3"), ("é{}", "ü^ß", "4")]
    lines = spark.createDataFrame(rows, "bucket string, file string, value string")
    plain = local(spark, "plain")
    lines.write.partitionBy("bucket", "file").text(plain)
    path = files.write_rolled_text(lines, local(spark, "rolled"))
    want = {b: {f.removeprefix("file="): open(f"{plain}/{b}/{f}/{p}").read() for f in os.listdir(f"{plain}/{b}") for p in os.listdir(f"{plain}/{b}/{f}")
                if p.startswith("part-")} for b in os.listdir(plain) if b.startswith("bucket=")}
    assert in_place(path) == want
    assert files.read_rolled_files(spark, path).agg(F.sum("cnt")).first()[0] == 4


def test_a_store_that_tasks_do_not_reach_by_path_gets_the_same_files(spark):
    lines = spark.range(60).selectExpr("concat('d ', id % 3) AS bucket", "concat('f-', id % 4, '.log') AS file", "cast(id AS string) AS value")
    path, store = files.write_rolled_text(lines, local(spark, "rolled")), local(spark, "store")
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.rolled.link./store", f"file://{store}")
    os.makedirs(store)
    files.write_rolled_text(lines, "viewfs://rolled/store/out")
    of = lambda at: {b: {f: sorted(t.splitlines()) for f, t in fs.items()} for b, fs in at.items()}
    seen = {b: {f: open(f"{store}/out/{b}/{f}").read() for f in os.listdir(f"{store}/out/{b}") if not f.endswith(".crc")} for b in os.listdir(f"{store}/out")
            if b.startswith("bucket=")}
    assert len(seen) == 3 and of(seen) == of(in_place(path))
