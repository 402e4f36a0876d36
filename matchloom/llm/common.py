"""What the training-data operators share: scratch tables and Arrow text buffers."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one is set only where the session names none."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="matchloom-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


class Scratch:
    """Tables of one query run, written to the shared folder so that lineage ends there.

    A lost executor costs only tasks: what was cut is read again from the shared folder.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"

    def cut(self, df: DataFrame, table: str) -> DataFrame:
        """Writes the table and reads it back. Its shuffle files go once it is written, as nothing reads them again."""
        conf, clean = self.spark.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = conf.get(clean, "false")
        conf.set(clean, "true")
        try:
            df.write.option("compression", "zstd").parquet(f"{self.root}/{table}")
        finally:
            conf.set(clean, before)
        return self.read(table, df.schema)

    def read(self, table: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}")

    def drop(self, table: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def text_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and the n + 1 offsets of a string or binary Arrow array; a null has length 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1] if offsets is not None and offsets.size else np.zeros(len(column) + 1, np.int32)
    at = at.astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int):
    """Ranges of rows with at most so many bytes together; a longer row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions starts[i] .. starts[i] + lengths[i] - 1 for every i, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


#: What a worker process keeps between tasks, by the name of the kernel that uses it; one at a time.
_KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]):
    """The worker's own table of that name. Those of other kernels go first, so memory is bounded by the largest of them."""
    if name not in _KEPT:
        forget()
        _KEPT[name] = make()
    return _KEPT[name]


def forget(but: str | None = None) -> None:
    if any(name != but for name in _KEPT):
        _KEPT.clear()
        gc.collect()
        release()


def release() -> None:
    """Gives unused memory of this process back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


#: Bytes of an Arrow batch, where the session leaves Spark's 64 MB; long texts count by their length.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "2m"


def lean(run: Callable, name: str | None = None) -> Callable:
    """The kernel, which drops what other kernels have kept in its worker when it starts, and gives free memory back when it ends.

    Sets the session's Arrow batches to a few MB unless it has a size of its own, so that tasks hold little more than that.
    """
    if (spark := SparkSession.getActiveSession()) and spark.conf.get(BATCH[0], None) in ("67108864b", "64m", "64MB"):
        spark.conf.set(*BATCH)

    def wrapped(batches):
        forget(name)
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped
