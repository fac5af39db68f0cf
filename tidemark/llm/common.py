"""What several operators share: row blocks of bounded size, text as bytes, the table folder."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import work_dir

BLOCK_BYTES = 4 << 20  # text that a Python task holds with its arrays at a time


def small_batches(spark: SparkSession) -> None:
    """Rows reach Python tasks in batches of bounded bytes; texts may be long, and rows of packed
    numbers are wide. Smaller limits that the session has already stay."""
    records = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(records)) <= 1000:
        spark.conf.set(records, "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in blocks of at most ``limit`` bytes of text; a longer text is one alone."""
    held, size = [], 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = int(np.searchsorted(ends, before + limit - size, side="right"))
            if stop <= start and held:
                yield pa.concat_batches(held)
                held, size = [], 0
                continue
            stop = max(stop, start + 1)
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1]) - before
            start = stop
    if held:
        yield pa.concat_batches(held)
    release()


def release() -> None:
    """Give freed memory back: workers live on, and share their machine with other tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries
        ctypes.CDLL(None).malloc_trim(0)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z alone; texts of plain ASCII take the faster built-in."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: what follows starts from files any executor sees."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
