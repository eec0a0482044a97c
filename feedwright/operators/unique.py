"""Keys that must occur once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.functions.text import pad_code, pad_whole, quoted
from feedwright.limits import DEFAULT_LIMITS, Limits
from feedwright.operators.joining import attach, key_columns, key_names
from feedwright.operators.sizing import settle


@dataclass(frozen=True)
class RepeatedKeys:
    table: DataFrame
    hot: DataFrame
    small: bool
    keys: int
    rows: int


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key as ``_n``; the key columns are named by ``key_names``."""
    return df.groupBy(*key_columns(keys)).agg(F.count(F.lit(1)).alias("_n"))


def single_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur exactly once; the key columns are named by ``key_names``."""
    return key_counts(df, keys).where("_n = 1").drop("_n")


def repeated_keys(
    df: DataFrame, keys: Sequence[str], rows: Column | None = None, limits: Limits = DEFAULT_LIMITS
) -> RepeatedKeys:
    """The keys that occur more than once among ``rows``.

    Counting combines within each task before the shuffle, so a key that holds
    a third of the rows travels as one row per task. Only the repeated keys are
    written.
    """
    counted = key_counts(df if rows is None else df.where(rows), keys).where("_n > 1")
    found = settle(counted, "repeated-keys", {"members": F.coalesce(F.sum("_n"), F.lit(0))}, sized=True)
    members = found.metrics["members"]
    hot = found.frame.where(F.col("_n") * limits.hot_share > members)
    return RepeatedKeys(
        found.frame, hot, limits.allow(found.rows, found.bytes), found.rows, members
    )


def flag_repeated(
    df: DataFrame,
    keys: Sequence[str],
    name: str = "_repeated",
    rows: Column | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """``df`` with a flag on every member of a repeated key.

    ``rows`` restricts which rows are counted and flagged. Keys compare with
    null equal to null, so each row lands on exactly one side.
    """
    found = repeated_keys(df, keys, rows, limits)
    if not found.keys:
        return df.withColumn(name, F.lit(False))
    table = found.table.select(*key_names(len(keys)), F.lit(True).alias("_hit"))
    hot = found.hot.select(*key_names(len(keys)), F.lit(True).alias("_hit"))
    out = attach(df, table, [F.col(quoted(k)) for k in keys], found.small, hot, null_safe=True)
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return out.withColumn(name, hit if rows is None else hit & rows).drop("_hit")


def split_unique(
    df: DataFrame, keys: Sequence[str], distinct_dups: bool = False, limits: Limits = DEFAULT_LIMITS
) -> tuple[DataFrame, DataFrame]:
    """Rows whose key occurs once, and all rows of the other keys.

    No member of a repeated key is kept as the good one. ``distinct_dups``
    collapses identical rows among the repeated ones.
    """
    flagged = flag_repeated(df, keys, limits=limits)
    once = flagged.where(~F.col("_repeated")).drop("_repeated")
    dups = flagged.where("_repeated").drop("_repeated")
    return once, dups.distinct() if distinct_dups else dups


def padded_collisions(df: DataFrame, name: str, width: int) -> DataFrame:
    """Codes that padding to ``width`` makes equal although they differ: it cuts those that are longer.

    One row per padded code with its number of different originals, its rows,
    and the first and last original. Codes that differ by leading zeros only are
    one code. Originals are made distinct before the shuffle by the code, so a
    code of any number of rows weighs as much as its originals.
    """
    own = F.col(quoted(name))
    originals = df.where(own.isNotNull()).groupBy(pad_whole(own, width).alias("original")).agg(F.count(F.lit(1)).alias("n"))
    codes = originals.groupBy(pad_code("original", width).alias("code")).agg(
        F.count(F.lit(1)).alias("originals"),
        F.sum("n").alias("rows"),
        F.min("original").alias("first_original"),
        F.max("original").alias("last_original"),
    )
    return codes.where("originals > 1")
