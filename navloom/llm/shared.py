"""Helpers of the training-data operators: tables, shared folders, Arrow slices, 64-bit mixing."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from navloom.session import new_folder, written

__all__ = ["count_by", "discard", "give_back", "keep", "mix64", "new_folder", "no_text", "read", "shuffles_dropped", "sliced", "text_of", "utf8", "whole_groups"]

#: Text handled at a time inside a task; bounds the numpy work arrays, never the result.
SLICE_BYTES = 1 << 21

#: The powers that hash words (see `words`), kept from batch to batch until a task ends.
POWERS: dict[str, np.ndarray] = {}

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within: a finished query's shuffle files go at once instead of at the driver's next garbage collection."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage through a Parquet table in the shared folder; its shuffles are dropped afterwards."""
    with shuffles_dropped(df.sparkSession):
        return written(df, name)


def discard(table: DataFrame) -> None:
    """Delete the files of a table made by `keep` that nothing reads any more."""
    spark = table.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def no_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the n + 1 offsets of its values; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + n + 1]
    if data_buffer is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(data_buffer, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def text_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """A text column of the batch, or the field of that name of its `record`."""
    if column in batch.schema.names:
        return batch.column(column)
    return pc.struct_field(batch.column("record"), column)


def sliced(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` bytes of text; a longer text is a batch of its own."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        offsets = utf8(text_of(batch, column))[1]
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end
    give_back()


def give_back() -> None:
    """Return freed memory to the system: a worker that waits for its next task should not hold the last one's."""
    POWERS.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The same rows, sorted by `keys` as they come, in batches that never split a group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        last = [batch.column(k)[batch.num_rows - 1].as_py() for k in keys]
        same = np.ones(batch.num_rows, bool)
        for k, value in zip(keys, last, strict=True):
            same &= pc.fill_null(pc.equal(batch.column(k), value), value is None).to_numpy(zero_copy_only=False)
        start = batch.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
        if start:
            yield _joined([*held, batch.slice(0, start)])
            held = []
        held.append(batch.slice(start))
    if held:
        yield _joined(held)
    held.clear()
    give_back()


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
