"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import functools
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side of a join is counted as small enough for every executor.
SMALL_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: what spark.checkpoint.dir (or setCheckpointDir) names.

    Where nothing is set, one machine (as in tests) gets a temporary folder; a cluster gets an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    own = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not folder and own.isDefined():
        folder = own.get()
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="aeros-shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write df as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor costs only the tasks that were running on it. The table stays
    until the owner of the shared folder clears it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/aeros-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """A stored table, marked to be sent to every executor if counting shows that it is small; else as it is."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


@functools.cache
def _trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # not glibc
        return None


def release() -> None:
    """Give freed memory back to the machine; Python workers outlive their tasks and would keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if (trim := _trim()) is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], after: Callable[[], None] | None = None) -> Callable:
    """run over the batches of a task, then `after` and release()."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            if after:
                after()
            release()

    return whole


def slices(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts (or bytes) in `column` come to about `most` bytes, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if batch.num_rows:
        yield batch.slice(start)
