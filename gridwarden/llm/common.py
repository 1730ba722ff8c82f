"""Helpers that several operators share: table reading, the shared folder, words, row keys, memory of Python workers."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII signs, blanks and controls; and what lies between them.
CASED_WORD, BETWEEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Broadcast on our word only what was measured to hold at most this many rows of a few dozen bytes.
BROADCAST_ROWS = 500_000
#: Bytes of text that a Python worker takes up at once from a batch.
PIECE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's `spark.checkpoint.dir`, or else below the session's warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{name}-{uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the shared folder and read back: short lineage that outlives executors."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def with_words(df: DataFrame, *kept: str) -> DataFrame:
    """The kept columns and `words`: the words of `text` in order, as they are written; null texts have none."""
    parts = F.split(F.coalesce(F.col("text"), F.lit("")), f"{BETWEEN}+", -1)
    cut = df.select(*kept, parts.alias("words"))
    lead = (F.element_at("words", 1) == "").cast("int")
    trail = ((F.size("words") > 1) & (F.element_at("words", -1) == "")).cast("int")
    return cut.withColumn("words", F.slice("words", lead + 1, F.size("words") - lead - trail))


def salted(key: Column, salts: int, *spread: Column) -> Column:
    """A salt from the given columns, so that a hot key's rows meet in many tasks."""
    return F.pmod(F.xxhash64(key, *spread), F.lit(salts)).cast("int")


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether the frame has at most so many rows; counts no further than that."""
    return df.limit(rows + 1).count() <= rows


def pieces(batch: pa.RecordBatch, text: str | int, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """All rows of a batch in order, in slices whose texts have so many bytes at most; a longer text has a slice of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < batch.num_rows:
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def frugal(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same work; when a task ends, its worker gives freed memory back to the system.

    Workers are kept for the tasks of later stages. What the allocators hold back would add to what those stages need.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    """Returns memory that was freed, but is kept by Arrow's pool and the C library's heap (glibc; others have no such call)."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError, TypeError):
        ctypes.CDLL(None).malloc_trim(0)
