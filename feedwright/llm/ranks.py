"""Places of rows within their group, counted without one task for a group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from feedwright.llm.common import Batches, lean, small_batches, stored


def group_starts(keys: pa.Array, before: object, first: bool) -> np.ndarray:
    """Which rows begin a group in a sorted batch; ``before`` is the key of the row ahead of it."""
    codes = keys.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[first or keys[0].as_py() != before], codes[1:] != codes[:-1]])
    return starts


def sorted_parts(
    df: DataFrame, group: str, order: list[Column], then: Batches | None = None, schema: str | None = None
) -> DataFrame:
    """``df`` sorted by range over all tasks, with ``part`` (the task) and ``at`` (the place in group and part).

    ``then`` works on the sorted batches in the same worker and gives rows of ``schema``.

    Ranges are cut by ``group``, ``order`` and a number of the row's own, so a
    group of any size, even one of equal rows, is dealt to many tasks; no task
    holds more than a batch of it.
    """
    small_batches(df.sparkSession)
    salt = F.xxhash64(F.monotonically_increasing_id())
    keys = [F.col(group).asc_nulls_first(), *order, F.col("salt").asc()]
    dealt = df.withColumn("salt", salt).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("salt")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        before, done, first = None, 0, True
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column(group)
            starts = group_starts(keys, before, first)
            row = np.arange(b.num_rows)
            opened = np.maximum.accumulate(np.where(starts, row, -1))
            at = np.where(opened >= 0, row - opened, row + done)
            before, done, first = keys[-1].as_py(), int(at[-1]) + 1, False
            extra = [pa.array(np.full(b.num_rows, part, np.int32)), pa.array(at.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([*b.columns, *extra], [*b.schema.names, "part", "at"])

    if then:
        return dealt.mapInArrow(lean(lambda batches: then(number(batches))), schema)
    extra = [StructField("part", IntegerType()), StructField("at", LongType())]
    return dealt.mapInArrow(lean(number), StructType([*dealt.schema.fields, *extra]))


def ranked(df: DataFrame, group: str, order: list[Column], purpose: str) -> DataFrame:
    """``df`` with ``rank``, the place from 0 of each row in its group, and ``total``, the group's rows."""
    rows = stored(sorted_parts(df, group, order), purpose)
    counts = rows.groupBy(F.col(group).alias("of"), "part").agg(F.count(F.lit(1)).alias("n"))
    # One row per task that holds a part of the group, so a window holds as many rows as there are tasks.
    whole = Window.partitionBy("of")
    ahead = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "of",
        F.col("part").alias("in_part"),
        F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"),
        F.sum("n").over(whole).alias("total"),
    )
    offsets = stored(offsets, f"{purpose}-offsets")
    both = rows.join(offsets, (F.col("part") == F.col("in_part")) & F.col(group).eqNullSafe(F.col("of")))
    return both.withColumn("rank", F.col("ahead") + F.col("at")).drop("of", "in_part", "ahead", "part", "at")


#: A key is hot from this share of the joined rows on, so there are at most as many hot keys.
HOT_SHARE = 1_000


def join_unique(left: DataFrame, right: DataFrame, keys: list[str], purpose: str) -> DataFrame:
    """Inner join with ``right``, whose ``keys`` are unique; both are read more than once and should be stored.

    Rows of a key that holds over a thousandth of ``left`` meet its one row of
    ``right`` by broadcast (at most a thousand rows); all others by a shuffle,
    where no key is large any more.
    """
    counts = stored(left.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")), f"{purpose}-keys")
    total = counts.agg(F.sum("rows").alias("n")).first()["n"] or 0
    least = max(HOT_SHARE, total // HOT_SHARE)
    hot = right.join(F.broadcast(counts.where(F.col("rows") > least).select(*keys)), keys)
    hot = F.broadcast(stored(hot, f"{purpose}-hot"))
    common = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(right, keys)
    return left.join(hot, keys).unionByName(common)
