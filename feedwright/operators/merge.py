"""Bringing clean rows into an accumulated snapshot."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.functions.dates import CONFORMED_FORMATS, parse_date
from feedwright.functions.text import quoted
from feedwright.limits import DEFAULT_LIMITS, Limits
from feedwright.operators.joining import key_columns, same_keys, shuffled
from feedwright.operators.rules import outside_range
from feedwright.operators.schema import cols
from feedwright.operators.setops import union_distinct
from feedwright.operators.sizing import measure


def append_distinct(history: DataFrame, clean: DataFrame) -> DataFrame:
    """History and clean rows, each row once."""
    return union_distinct(history, clean)


def new_rows(history: DataFrame, clean: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Distinct clean rows that history lacks: what appending has to write.

    When the clean rows were counted and are few, history is read past them
    without a shuffle and only its matching rows come back.
    """
    # Counted ahead of the distinct: an upper bound that needs no shuffle.
    (rows, size), = measure([clean])
    clean = clean.distinct()
    same = same_keys(cols(clean.columns), null_safe=True)
    if limits.allow(rows, size):
        wanted = clean.select(*key_columns(clean.columns))
        present = (
            history.select(*cols(clean.columns))
            .join(F.broadcast(wanted), same, "left_semi")
            .select(*key_columns(clean.columns))
            .distinct()
        )
        return clean.join(present, same, "left_anti")
    return clean.join(history.select(*key_columns(clean.columns)), same, "left_anti")


def without_keys(
    history: DataFrame, clean: DataFrame, keys: Sequence[str], limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """History rows whose key is not among the clean rows.

    Few clean keys are broadcast past history. Otherwise both sides are
    shuffled as plain columns, where Spark splits an oversized key at run time.
    """
    wanted = clean.select(*key_columns(keys))
    (rows, size), = measure([wanted])
    wanted = F.broadcast(wanted) if limits.allow(rows, size) else shuffled(wanted)
    return history.join(wanted, same_keys(cols(keys), null_safe=False), "left_anti")


def upsert(
    history: DataFrame,
    clean: DataFrame,
    keys: Sequence[str],
    distinct: bool = True,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Clean rows replace the history rows of their keys.

    A key that was quarantined is not among the clean rows, so its history row
    stays. ``distinct=False`` leaves out the final distinct; it is right when
    history holds each row once, as snapshots written by this library do, and
    ``clean`` holds each key once.
    """
    merged = without_keys(history, clean, keys, limits).unionByName(clean)
    return merged.distinct() if distinct else merged


def date_bounds(df: DataFrame, day: Column) -> tuple[dt.date | None, dt.date | None]:
    """First and last date, brought to the driver as literals for pruning."""
    row = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).first()
    return row["lo"], row["hi"]


def feed_day(name: str, formats: Sequence[str] = CONFORMED_FORMATS) -> Column:
    return parse_date(F.col(quoted(name)), *formats)


def replace_range(
    history: DataFrame,
    clean: DataFrame,
    day: Column,
    scope: str = "range",
    bounds: tuple[dt.date | None, dt.date | None] | None = None,
    distinct: bool = True,
) -> DataFrame:
    """Clean rows replace history over the dates from their first to their last.

    ``day`` is the date expression on either frame. ``scope='range'`` drops
    every history row inside the bounds, delivered date or not;
    ``scope='dates'`` drops only delivered dates. History rows without a
    readable date stay, and an empty delivery changes nothing.

    ``distinct=False`` leaves history out of the final distinct; it is right
    when history holds each row once, and then history is not shuffled.
    """
    if scope == "dates":
        delivered = clean.select(day.alias("_k0")).where("_k0 is not null").distinct()
        # One row per calendar date at most.
        kept = history.join(F.broadcast(delivered), same_keys([day], null_safe=False), "left_anti")
    elif scope == "range":
        lo, hi = bounds or date_bounds(clean, day)
        kept = history.where(outside_range(day, lo, hi))
    else:
        raise ValueError(f"scope must be 'range' or 'dates', not {scope!r}")
    return union_distinct(kept, clean) if distinct else kept.unionByName(clean.distinct())


def per_file(clean: DataFrame) -> DataFrame:
    """Distinct rows of each file; ``clean`` carries its file column."""
    return clean.distinct()
