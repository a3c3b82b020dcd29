"""Append-only JSON lines, as a file or as a folder of files: all lines count but a file's last one that a crash cut short."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger("capsweep.jsonl")


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def _ended(spark: SparkSession, path: str) -> bool:
    """Whether a file's last byte ends a line."""
    fs, target = _file_system(spark, path)
    size = fs.getFileStatus(target).getLen()
    if not size:
        return True
    stream = fs.open(target)
    try:
        stream.seek(size - 1)
        return stream.read() == 10
    finally:
        stream.close()


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Rows with `line_no`, their place among non-blank lines, files in order of their paths. A line that isn't JSON is an
    error, unless it is its file's last and no newline ends it: such a line is left out and logged. A missing path has
    no rows. Folders are read to any depth."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if not exists(spark, path):
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("line_no", T.LongType())]))
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b")).where(F.trim("value") != "")
    # one task reads a block from its begin to its end, so ids count its lines
    numbered = lines.withColumn("o", F.monotonically_increasing_id())
    per = numbered.groupBy("f", "b").agg(F.count("*").alias("n"), F.min("o").alias("first"))
    # a row for each block
    base = per.select("f", "b", "first", (F.sum("n").over(Window.orderBy("f", "b")) - F.col("n")).alias("before"))
    inner = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    rows = numbered.join(base, ["f", "b"]).select("f", F.from_json("value", inner, {"columnNameOfCorruptRecord": "_bad"}).alias("r"), (F.col("o") - F.col("first") + F.col("before") + 1).alias("line_no"))
    bad = rows.where("r._bad is not null").groupBy("f").agg(F.min("line_no").alias("first"), F.count("*").alias("n"))
    bad = bad.join(rows.groupBy("f").agg(F.max("line_no").alias("last")), "f")
    wrong = bad.where("n > 1 or first < last").select("first").orderBy("first").limit(1).collect()
    if wrong:
        raise ValueError(f"{path}: line {wrong[0]['first']} is not JSON")
    for r in bad.select("f", "last").toLocalIterator():  # files whose last line alone is no JSON
        if _ended(spark, r["f"]):
            raise ValueError(f"{path}: line {r['last']} is not JSON")
        log.warning("jsonl.tornLineDropped path=%s line=%s", r["f"], r["last"])
    return rows.where("r._bad is null").select(*[F.col("r")[f.name].alias(f.name) for f in schema.fields], "line_no")


def append_jsonl(df: DataFrame, path: str, batch: str | None = None) -> None:
    """Further files under path, each committed whole. batch: a name, under which the same rows are written but once."""
    if batch is None:
        df.write.mode("append").json(path)
    else:
        df.write.mode("overwrite").json(f"{path}/{batch}")
