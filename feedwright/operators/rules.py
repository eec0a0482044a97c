"""Key rules: which rows may go on."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.functions.dates import UNPARSABLE
from feedwright.functions.text import as_column, quoted


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _text(name: str) -> Column:
    return F.col(quoted(name)).cast("string")


def bad_key(keys: Sequence[str], dates: Sequence[str] = (), zero_is_bad: bool = True) -> Column:
    """True when any key is null, blank, ``0`` or, for a date key, unparsable. Never null."""

    def one(name: str) -> Column:
        unwanted = [""] + (["0"] if zero_is_bad else []) + ([UNPARSABLE] if name in dates else [])
        return _text(name).isNull() | _text(name).isin(unwanted)

    return _any([one(name) for name in keys])


def bad_measure(names: Sequence[str], string_order: bool = False) -> Column:
    """True when any measure is blank or negative.

    By default the number is compared. ``string_order`` compares the text with
    ``'0'`` instead, as older outputs did: ``.5`` fails there and ``abc`` passes.
    """

    def one(name: str) -> Column:
        text = _text(name)
        negative = text < "0" if string_order else text.try_cast("double") < 0
        return text.isNull() | (text == "") | F.coalesce(negative, F.lit(False))

    return _any([one(name) for name in names])


def planogram_rule(filled: Sequence[str], measures: Sequence[str], string_order: bool = False) -> Column:
    """Every ``filled`` column non-blank, every measure non-blank and not negative."""
    return bad_key(filled, zero_is_bad=False) | bad_measure(measures, string_order)


def any_present(names: Sequence[str]) -> Column:
    """True when at least one of the columns is not null."""
    return _any([F.col(quoted(n)).isNotNull() for n in names])


def split(df: DataFrame, bad: Column | str) -> tuple[DataFrame, DataFrame]:
    """Rows that pass and rows that fail; ``bad`` must not be null."""
    bad = as_column(bad)
    return df.where(~bad), df.where(bad)


def outside_range(day: Column, lo: object, hi: object) -> Column:
    """Rows that a delivery from ``lo`` to ``hi`` leaves alone.

    Rows without a readable date stay, and so does everything when the
    delivery is empty and its bounds are null.
    """
    if lo is None or hi is None:
        return F.lit(True)
    # One use of ``day``: it is usually parsed from text, and an OR would parse it again.
    return ~F.coalesce(day.between(F.lit(lo), F.lit(hi)), F.lit(False))


def within_half_open(value: Column, lo: Column, hi: Column) -> Column:
    return (value >= lo) & (value < hi)
