"""Which weeks a snapshot lacks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.functions.dates import (
    CONFORMED,
    CONFORMED_FORMATS,
    parse_date,
    saturday_of_week,
    saturday_on_or_before,
    short_date,
    week_start,
)
from feedwright.functions.text import quoted


def _day(name: str, formats: Sequence[str]) -> Column:
    return parse_date(F.col(quoted(name)), *formats)


def missing_weeks(
    df: DataFrame,
    date_col: str,
    as_of: dt.date,
    dataset: str,
    formats: Sequence[str] = CONFORMED_FORMATS,
    text_order: bool = False,
) -> DataFrame:
    """One row per Saturday from the first data week to ``as_of``.

    ``Availability`` is Yes when the snapshot holds any date of that Saturday's
    Sunday-to-Saturday week. Unreadable dates are left out. ``text_order``
    sorts by the date text instead of by time.
    """
    # One scan: rows are brought down to one per calendar week, and those few
    # rows to the bounds and the list of weeks that hold data.
    weekly = (
        df.select(_day(date_col, formats).alias("_d"))
        .groupBy(week_start("_d").alias("_week"))
        .agg(F.min("_d").alias("_first"), F.max("_d").alias("_last"))
    )
    found = weekly.agg(
        F.min("_first").alias("_lo"), F.max("_last").alias("_hi"), F.collect_set("_week").alias("_weeks")
    )
    last = saturday_on_or_before(F.lit(as_of))
    first = saturday_of_week("_lo")
    spine = found.where(first <= last).select(
        "*", F.explode(F.sequence(first, last, F.expr("interval 7 days"))).alias("_saturday")
    )
    has_data = F.array_contains("_weeks", week_start("_saturday"))
    report = spine.select(
        F.lit(dataset).alias("Dataset_Name"),
        F.date_format("_saturday", CONFORMED).alias(date_col),
        F.when(has_data, "Yes").otherwise("No").alias("Availability"),
        F.lit(as_of.strftime("%m/%d/%Y")).alias("DBInsertDate"),
        short_date("_lo").alias("MinDate"),
        short_date("_hi").alias("MaxDate"),
        "_saturday",
    )
    return report.orderBy(quoted(date_col) if text_order else "_saturday").drop("_saturday")


def unreadable_dates(df: DataFrame, date_col: str, formats: Sequence[str] = CONFORMED_FORMATS) -> DataFrame:
    """How many rows hold no readable date."""
    return df.agg(unreadable_count(date_col, formats).alias("unreadable"))


def unreadable_count(date_col: str, formats: Sequence[str] = CONFORMED_FORMATS) -> Column:
    return F.count_if(_day(date_col, formats).isNull())


def first_and_last_day(
    df: DataFrame, date_col: str, formats: Sequence[str] = CONFORMED_FORMATS
) -> DataFrame:
    """Earliest and latest date, without sorting."""
    return df.agg(
        F.min(_day(date_col, formats)).alias("first_day"),
        F.max(_day(date_col, formats)).alias("last_day"),
    )
