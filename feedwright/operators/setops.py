"""Row-set operators by column name."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedwright.limits import DEFAULT_LIMITS, Limits
from feedwright.operators.joining import key_columns, same_keys
from feedwright.operators.schema import cols
from feedwright.operators.sizing import settle

#: Types whose values are equal only when their hashes are; zero and minus zero of a double are not.
_HASHED = {T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.DateType()}
#: Rows per repeated hash from which combining within tasks is better than telling repeated rows apart.
MANY_COPIES = 4


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*frames).distinct()


def distinct_rows(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """``df.distinct()``; where copies are rare, only rows whose hash occurs again are shuffled as a whole.

    A distinct of rows that are nearly all different holds each task's rows in
    memory and then shuffles them all. Here 64 bits of each row are counted
    first. Rows with a hash of their own are distinct; the others, copies and
    rows whose hashes collide, are compared as a whole. ``df`` is evaluated
    again for that, so it must give the same rows each time.
    """
    if not {f.dataType for f in df.schema} <= _HASHED:
        return df.distinct()
    columns = cols(df.columns)
    row = F.xxhash64(*columns, *[c.isNull() for c in columns])
    counted = df.select(row.alias("_k0")).groupBy("_k0").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    again = settle(counted, "repeated-hashes", {"members": F.coalesce(F.sum("_n"), F.lit(0))}, sized=True)
    if not again.rows:
        return df
    if again.metrics["members"] >= MANY_COPIES * again.rows or not limits.allow(again.rows, again.bytes):
        return df.distinct()
    few = F.broadcast(again.frame.select("_k0"))
    once = df.join(few, row == F.col("_k0"), "left_anti")
    return once.unionByName(df.join(few, row == F.col("_k0"), "left_semi").distinct())


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` lacks."""
    return left.subtract(right.select(*cols(left.columns)))


def except_keep_copies(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of ``left``, copies included, that ``right`` lacks."""
    other = right.select(*key_columns(left.columns))
    return left.join(other, same_keys(cols(left.columns), null_safe=True), "left_anti")


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*cols(keys)).distinct()
