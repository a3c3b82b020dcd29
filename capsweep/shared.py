"""The folder that the driver and all executors share, and tables that end a plan's lineage there."""

from __future__ import annotations

import atexit
import gc
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_cut: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of this machine only where no other machine takes part."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "/tmp/checkpoints/capsweep"


def delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _clean() -> None:
    for spark, path in _cut:
        try:
            delete(spark, path)
        except Exception:  # the session may have ended; the folder is the cluster's to empty
            pass


def cut(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read again: its lineage ends here. The table goes with the program."""
    path = f"{shared_folder(df.sparkSession)}/level-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _cut.append((df.sparkSession, path))
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.shared_path = path
    return back


def tasks(spark: SparkSession) -> int:
    """As many as the session shuffles to, and no fewer than run at once."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are made once a row, however often later steps name them: a plan takes up what steps before it select
    into their conditions, but not what a generator gives."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


def byte_slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in pieces whose bodies have at most `most` bytes together, or are one: what Python makes of a body is
    many times its size."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_pylist()
        begin = held = 0
        for i, size in enumerate(sizes):
            if i > begin and held + size > most:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += size
        if begin < len(sizes):
            yield batch.slice(begin)


def uncollected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, while the collector of cycles rests: it would walk all that is made of a batch again and again, and trees have no cycles."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield from batches
    finally:
        if was:
            gc.enable()


def drop(df: DataFrame) -> None:
    """Delete a table made by cut() that no later plan reads."""
    path = getattr(df, "shared_path", None)
    if path:
        delete(df.sparkSession, path)
