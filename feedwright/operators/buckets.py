"""Splitting a table into spans of weeks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.functions.dates import CONFORMED_FORMATS
from feedwright.operators.merge import date_bounds, feed_day


def bucket_weeks(
    df: DataFrame,
    date_col: str,
    weeks: int = 52,
    formats: Sequence[str] = CONFORMED_FORMATS,
    name: str = "bucket",
) -> DataFrame:
    """Number of the half-open ``weeks``-long span, counted from the first date.

    The last date falls into a bucket like any other. Unreadable dates get null.
    """
    day = feed_day(date_col, formats)
    lo, _ = date_bounds(df, day)
    span = F.floor(F.date_diff(day, F.lit(lo).cast("date")) / F.lit(7 * weeks))
    return df.withColumn(name, span.cast("int"))
