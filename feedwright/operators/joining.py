"""One left join for every lookup table, whatever its size.

A lookup table here is unique on its key columns ``_k0``, ``_k1`` ... and
carries payload columns. Three ways to join it, all exact:

* it was counted and is small: broadcast it, the feed is not shuffled;
* it is large and no hot keys are known: a shuffle join;
* it is large and the feed's hot keys are known: a shuffle join on the key and a
  salt. Rows of hot keys get a salt from their content, the few lookup rows of
  hot keys are repeated for every salt, and all other rows have salt 0, so the
  feed is read once and no task gets a whole hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.functions.text import quoted


#: Parts that the rows of one hot key are dealt to.
SALTS = 64


def key_names(n: int) -> list[str]:
    return [f"_k{i}" for i in range(n)]


def key_columns(names: Sequence[str], exprs: Sequence[Column] | None = None) -> list[Column]:
    exprs = exprs or [F.col(quoted(n)) for n in names]
    return [e.alias(k) for e, k in zip(exprs, key_names(len(names)))]


def same_keys(exprs: Sequence[Column], null_safe: bool) -> Column:
    pairs = zip(exprs, [F.col(k) for k in key_names(len(exprs))])
    return reduce(lambda a, b: a & b, [e.eqNullSafe(k) if null_safe else e == k for e, k in pairs])


def shuffled(table: DataFrame) -> DataFrame:
    """``table`` for a join that must not broadcast it: it was counted and is large.

    Left to itself Spark goes by the bytes of files, divided among all their columns. A key beside columns
    that are mostly null or repeated seems tiny then, and millions of rows would be sent to the driver.
    """
    return table.hint("merge")


def attach(
    df: DataFrame,
    table: DataFrame,
    exprs: Sequence[Column],
    small: bool,
    hot: DataFrame | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """``df`` with the payload of ``table``, null where the key is not in it.

    ``hot`` holds the rows of ``table`` for the hot keys; there are at most
    ``Limits.hot_share`` of them, which is why they may be broadcast.
    """
    on = same_keys(exprs, null_safe)
    keys = key_names(len(exprs))
    if small:
        return df.join(F.broadcast(table), on, "left").drop(*keys)
    if hot is None:
        return df.join(shuffled(table), on, "left").drop(*keys)
    few = F.broadcast(hot.select(*keys, F.lit(True).alias("_hot")))
    spread = F.when(F.col("_hot"), F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in df.columns]), F.lit(SALTS)))
    salted = df.join(few, on, "left").withColumn("_salt", F.coalesce(spread.cast("int"), F.lit(0))).drop(*keys, "_hot")
    same = reduce(lambda a, b: a & b, [F.col(f"t.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys])
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    repeated = table.alias("t").join(few.alias("h"), same, "left").select("t.*", F.explode(salts).alias("_part"))
    return salted.join(shuffled(repeated), on & (F.col("_salt") == F.col("_part")), "left").drop(*keys, "_salt", "_part")
