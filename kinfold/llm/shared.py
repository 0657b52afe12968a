"""What several operators need: places on shared storage, Arrow batches cut by size, hashes of words."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words, as bytes: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = bytes([32, 9, 10, 11, 12, 13])
#: Text bytes that one step of a numpy kernel takes, so its arrays stay within some tens of MB.
CHUNK_BYTES = 1 << 19
#: Bytes of an Arrow batch between Spark and Python, and the setting that says so.
BATCH_BYTES, BATCH_SETTING = 2 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; one of our own only where none is set, as in tests on one machine."""
    known = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if known is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        known = tempfile.mkdtemp(prefix="kinfold-llm-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(known)
    return known.rstrip("/")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Bound the bytes of Arrow batches for what runs inside, as texts of thousands of rows are large."""
    before = spark.conf.get(BATCH_SETTING, None)
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_SETTING)
        else:
            spark.conf.set(BATCH_SETTING, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once as Parquet on shared storage and read back: lost executors cost no lineage.

    Zstandard, as several copies of the texts may lie there at once.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with small_batches(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """A small intermediate result, computed once and kept on shared storage."""
    shared_folder(df.sparkSession)
    with small_batches(df.sparkSession):
        return df.checkpoint(eager=True)


def spread_text(df: DataFrame) -> DataFrame:
    """Deal out input that arrives in fewer splits than the cluster has cores; else leave it alone."""
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def plain(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under names of our own, so extra or clashing ones do no harm."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column one after another, and where each row begins and the last ends."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of whole rows with about `most` bytes of text (one row alone may have more)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, at = flat_bytes(batch.column(text))
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(at, at[begin] + most, "right")) - 1)
            yield batch.slice(begin, end - begin)
            begin = end
    # Python workers live on between tasks and should not keep what Arrow and numpy no longer need.
    pa.default_memory_pool().release_unused()
    give_back()


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def forget_words() -> None:
    """Drop what tasks of the tokenizing operators left in this worker, and return the memory.

    Workers serve one stage after another; stages that need memory of their own begin with this.
    """
    if sys.modules.pop("kinfold_task_memory", None) is not None:
        give_back()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A random odd-looking value for every byte.
BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


class RangeHash:
    """64-bit hashes of any byte range of one buffer, from prefix sums of a polynomial."""

    def __init__(self, raw: np.ndarray):
        n = len(raw)
        powers = np.full(n, BASE, np.uint64)
        if n:
            powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUES[raw] * powers, out=self.sums[1:])
        self.back = np.full(n + 1, INVERSE, np.uint64)
        self.back[0] = 1
        np.multiply.accumulate(self.back, out=self.back)

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.sums[end] - self.sums[begin]) * self.back[begin]
        return mixed(value + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def word_bounds(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word (a run of bytes other than white space), and the first word of each row.

    The third result has one entry more than there are rows.
    """
    n = len(raw)
    word = np.zeros(n + 2, bool)
    word[1:-1] = ~_IS_SPACE[raw]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    here, before = word[1:], word[:-1]
    begin = np.flatnonzero(here & (~before | edge))
    end = np.flatnonzero(before & (~here | edge))
    return begin, end, np.searchsorted(begin, at, "left")


def runs_of(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of `size` words inside a row, and the index of its first word."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        total *= np.uint64(BASE)
        total += hashes[k : n - size + 1 + k]
    row_end = np.repeat(first[1:], np.diff(first))[: n - size + 1]
    whole = np.arange(n - size + 1) + size <= row_end
    return mixed(total[whole]), np.flatnonzero(whole)
