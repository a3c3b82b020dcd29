"""Shared plumbing of the corpus operators: table access, shared-folder tables, Arrow helpers."""

from __future__ import annotations

import atexit
import gc
import pickle
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only where the session names no shared folder (tests, a single machine).
LOCAL_CHECKPOINTS = "/tmp/checkpoints/capsweep"
#: Bounds of one Arrow batch, and of the texts that an operator works on at once.
BATCH_ROWS, BATCH_BYTES, SLICE_BYTES = 10_000, 4 << 20, 1 << 20
_written: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share; one of this machine only where no other takes part."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if not named and (not master.startswith("local") or master.startswith("local-cluster")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return named or LOCAL_CHECKPOINTS


def bounded_batches(spark: SparkSession) -> None:
    """Batches that go to Python end at BATCH_BYTES or BATCH_ROWS. Plans read this when they run, so every operator asks for the same."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def text_slices(batches: Iterator[pa.RecordBatch], column: int, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a piece's texts have at most `most` bytes together, or are one text: the work on a
    piece takes many times its size."""
    most = most or SLICE_BYTES
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        begin, before = 0, 0
        while begin < n:
            end = max(begin + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(begin, end - begin)
            begin, before = end, int(ends[end - 1])


_caches: dict[str, Callable[[], None]] = {}


def claim(owner: str, clear: Callable[[], None]) -> None:
    """What a worker remembers for an operator goes when it begins to work for another. clear: empties the owner's."""
    if owner not in _caches:
        for other in list(_caches):
            _caches.pop(other)()
        gc.collect()
        pa.default_memory_pool().release_unused()
    _caches[owner] = clear


def in_one_task(sample: DataFrame, order: list[str], train: Callable[[Iterator[dict]], object]) -> object:
    """What train makes of a sample's rows, in order: a model, pickled. sample is bounded by its caller; it goes to one
    executor, and the driver sees the model alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = train(r for batch in batches for r in batch.to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(made)], pa.binary())], ["model"])

    bounded_batches(sample.sparkSession)
    made = sample.repartition(1).sortWithinPartitions(*order).mapInArrow(run, "model binary").collect()  # one row, or none
    return pickle.loads(made[0][0]) if made else train(iter(()))


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may have ended; the folder is the cluster's to empty
        pass


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        _delete(spark, path)


#: Spark deletes a statement's shuffle files when it ends; without it, when the driver's garbage is collected next.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str = "step") -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends here and survives lost executors. What was shuffled for it goes at once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    _written.append((spark, path))
    back = spark.read.schema(df.schema).parquet(path)
    back.shared_path = path
    return back


def release(df: DataFrame) -> None:
    """Delete a table made by materialise() that no later plan reads."""
    path = getattr(df, "shared_path", None)
    if path:
        _delete(df.sparkSession, path)


def fold():
    """crc32 of the id's text modulo 3; 1 marks held-out rows, null ids are never held out and never learnt from."""
    return F.crc32(F.col("doc_id").cast("string")) % 3


def text_or_empty(values: pa.Array) -> list[str]:
    return [x or "" for x in values.to_pylist()]


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys in batches that arrive sorted by keys; a run may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        rows = list(zip(*(batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys), strict=True))
        begin = 0
        for i in range(n):
            if rows[i] != last:
                if i > begin:
                    held.append(batch.slice(begin, i - begin))
                if held:
                    yield pa.Table.from_batches(held)
                held, begin, last = [], i, rows[i]
        if begin < n:
            held.append(batch.slice(begin))
    if held:
        yield pa.Table.from_batches(held)
