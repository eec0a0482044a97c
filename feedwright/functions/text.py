"""Text clean-up expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_quotes(c: Column | str) -> Column:
    """Without double quotes; null becomes the empty string."""
    return F.coalesce(F.replace(as_column(c), F.lit('"'), F.lit("")), F.lit(""))


def strip_line_quotes(c: Column | str) -> Column:
    """A text line without double quotes."""
    return F.replace(as_column(c), F.lit('"'), F.lit(""))


def strip_chars(c: Column | str, chars: str) -> Column:
    """Without any of ``chars``; null stays null."""
    return F.translate(as_column(c), chars, "")


def pad_code(c: Column | str, width: int) -> Column:
    """Left-padded with zeros to ``width``; longer codes are cut to it."""
    return F.lpad(as_column(c), width, "0")


def pad_whole(c: Column | str, width: int) -> Column:
    """Left-padded with zeros to ``width``; longer codes stay as they are."""
    c = as_column(c)
    return F.lpad(c, F.greatest(F.length(c), F.lit(width)), F.lit("0"))


def upper_key(c: Column | str) -> Column:
    return F.upper(as_column(c))


def blank_to_null(c: Column | str) -> Column:
    """Null when only white space, otherwise unchanged."""
    c = as_column(c)
    return F.when(F.length(F.trim(c)) > 0, c)


def replace_text(c: Column | str, *pairs: tuple[str, str]) -> Column:
    """Every literal ``old`` replaced by ``new``, pair after pair."""
    return reduce(lambda acc, pair: F.replace(acc, F.lit(pair[0]), F.lit(pair[1])), pairs, as_column(c))


def row_text(columns: Sequence[Column | str]) -> Column:
    """All values joined by commas, nulls printed as ``null``."""
    return F.concat_ws(",", *[F.coalesce(as_column(c).cast("string"), F.lit("null")) for c in columns])


def dataset_name(c: Column | str) -> Column:
    """File name without its ``.csv`` ending."""
    return F.regexp_replace(as_column(c), r"\.csv$", "")


def quoted(name: str) -> str:
    """A column name that is safe in ``F.col``: feed headers hold dots, blanks and slashes."""
    return "`" + name.replace("`", "``") + "`"
