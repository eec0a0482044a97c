"""Helpers shared by the operators: reading tables, scratch tables, Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache, wraps
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.session import scratch_path

ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Later steps start from files that every executor reaches, so a lost
    executor costs only its running tasks.
    """
    path = scratch_path(df.sparkSession, f"llm-{purpose}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_narrow(df: DataFrame, purpose: str) -> DataFrame:
    """``stored`` for the result of an aggregation over ids and hashes, in an eighth of the shuffle's partitions.

    Partitions are laid out for documents; rows of a few numbers, one for each
    key by now, need fewer tasks and files. Where Spark has brought partitions
    together already, this changes nothing.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(df.coalesce(max(1, partitions // 8)), purpose)


#: Rows that one Arrow batch carries at most, so that a batch of long texts stays small.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch rows to ``BATCH_ROWS`` where they are higher or unbounded."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def doc_columns(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone; other columns never reach an operator."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def whole_rows(docs: DataFrame) -> DataFrame:
    """Each row as the struct ``row`` beside its ``id``, so that no added column can clash."""
    small_batches(docs.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, F.col("doc_id").cast("bigint").alias("id"))


def id_key(name: str) -> Column:
    """A document id as a join key that also matches null with null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_crc(name: str = "doc_id") -> Column:
    """crc32 of a key written as text; 0 for null."""
    return F.coalesce(F.crc32(F.col(name).cast("string")), F.lit(0))


@cache
def c_library() -> ctypes.CDLL | None:
    """The C library of this worker where it can return freed memory to the machine, else None."""
    library = ctypes.CDLL(None)
    return library if hasattr(library, "malloc_trim") else None


def give_back() -> None:
    """Return what this worker has freed to the machine; workers are reused over stages and tasks."""
    pa.default_memory_pool().release_unused()
    if library := c_library():
        library.malloc_trim(0)


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def lean(run: Batches) -> Batches:
    """``run`` for ``mapInArrow``, in a worker that returns its memory behind each task."""

    @wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``limit`` bytes of text each; a longer text stands alone."""
    sizes = batch.column(column)
    ends = list(accumulate(len(x) if (x := v.as_buffer()) is not None else 0 for v in sizes))
    start, done = 0, 0
    for i, end in enumerate(ends):
        if end - done > limit and i > start:
            yield batch.slice(start, i - start)
            start, done = i, ends[i - 1]
    if start < batch.num_rows:
        yield batch.slice(start)
    give_back()


def utf8_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """Texts as UTF-8; null counts as empty."""
    return [b or b"" for b in batch.column(column).cast(pa.binary()).to_pylist()]


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts; null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_BYTE_VALUE = np.random.default_rng(5).integers(1, 1 << 63, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes whose words are hashed at a time.
HASH_BLOCK = 4_000_000


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    power = np.full(len(data), _BASE, np.uint64)
    power[:1] = 1
    power = np.multiply.accumulate(power)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE_VALUE[data] * power, dtype=np.uint64)])
    x = power[begin]
    inverse = x.copy()  # of an odd number modulo 2^64, by Newton's iteration
    for _ in range(5):
        inverse *= np.uint64(2) - x * inverse
    sums = (prefix[end] - prefix[begin]) * inverse
    return mixed(sums + (end - begin).astype(np.uint64) * _BASE)


class Words:
    """The words of many texts at once: runs of bytes outside ``separators``, with 64-bit hashes.

    ``begin`` and ``end`` are places in ``raw``; words of document ``d`` are
    numbered from ``first[d]`` up to ``first[d + 1]``. A hash is a polynomial over
    the word's bytes, taken from prefix sums and divided by its place's power.
    """

    def __init__(self, parts: list[bytes], separators: tuple[int, ...] = SPACES) -> None:
        gap = bytes(separators[:1])
        self.raw = gap.join(parts) + gap
        data = np.frombuffer(self.raw, np.uint8)
        is_word = np.ones(256, bool)
        is_word[list(separators)] = False
        inside = np.concatenate([[False], is_word[data], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.begin, self.end = edges[::2], edges[1::2]
        self.hashes = np.zeros(len(self.begin), np.uint64)
        at = 0
        while at < len(self.begin):
            # As many words as one block of bytes holds, so that a long text needs no arrays of its length.
            stop = max(at + 1, int(np.searchsorted(self.end, self.begin[at] + HASH_BLOCK, side="right")))
            low = self.begin[at]
            self.hashes[at:stop] = word_hashes(
                data[low : self.end[stop - 1]], self.begin[at:stop] - low, self.end[at:stop] - low
            )
            at = stop
        ends = np.cumsum([len(p) + 1 for p in parts])
        self.first = np.concatenate([[0], np.searchsorted(self.begin, ends)])

    def shingles(self, size: int) -> np.ndarray:
        """Hash of the ``size`` words from each word on; meaningless where a document ends before."""
        n = max(0, len(self.hashes) - size + 1)
        out = np.zeros(n, np.uint64)
        for i in range(size):
            out += self.hashes[i : i + n] * np.uint64(pow(int(_BASE), i + 1, 1 << 64))
        return mixed(out)
