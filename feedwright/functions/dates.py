"""Date expressions over text dates."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedwright.functions.text import as_column

# The text put in place of a date that cannot be read, the same
# for a week label, and the date form of every conformed column.
UNPARSABLE = "Unparceable"
UNPARSABLE_WEEK = "Unparcable"
CONFORMED = "MM/dd/yyyy"

# Spark formats that read a conformed date.
CONFORMED_FORMATS = ("M/d/yyyy",)


# Least and most digits that each run of letters in a numeric date format reads.
_DIGITS = {"yyyy": (4, 4), "yy": (2, 2), "MM": (2, 2), "dd": (2, 2), "M": (1, 2), "d": (1, 2)}


def text_frame(form: str) -> tuple[int, int, list[str]] | None:
    """Shortest and longest text a numeric date format reads, and its separators; None for other formats."""
    runs = [m.group() for m in re.finditer(r"([A-Za-z])\1*|[^A-Za-z]", form)]
    if any(r[0].isalpha() and r not in _DIGITS for r in runs):
        return None
    sizes = [_DIGITS.get(r, (1, 1)) for r in runs]
    separators = sorted({r for r in runs if not r.isalpha()})
    return sum(s[0] for s in sizes), sum(s[1] for s in sizes), separators


def _parsed(c: Column, form: str) -> Column:
    # The parser throws inside for a text it cannot read, which costs many times
    # a match, and unreadable dates come in bulk: a wrong length or a missing
    # separator is found first, at almost no cost.
    parsed, frame = F.try_to_date(c, form), text_frame(form)
    if frame is None:
        return parsed
    shortest, longest, separators = frame
    fits = F.octet_length(c).between(shortest, longest)
    for separator in separators:
        fits = fits & F.contains(c, F.lit(separator))
    return F.when(fits, parsed)


def parse_date(c: Column | str, *formats: str) -> Column:
    """A date from the first format that fits; null when none does."""
    c = as_column(c)
    return F.coalesce(*[_parsed(c, f) for f in formats])


def reformat_date(c: Column | str, *formats: str, unparsable: str = UNPARSABLE) -> Column:
    """The date as ``MM/dd/yyyy`` text, or the sentinel text."""
    return F.coalesce(F.date_format(parse_date(c, *formats), CONFORMED), F.lit(unparsable))


def epoch_millis(c: Column | str, *formats: str) -> Column:
    """Milliseconds since 1970 at the start of the day; 0 when unreadable."""
    parsed = parse_date(c, *formats).cast("timestamp")
    return F.coalesce(F.unix_millis(parsed), F.lit(0).cast("bigint"))


def date_year(c: Column | str, *formats: str) -> Column:
    """Calendar year; 0 when unreadable."""
    return F.coalesce(F.year(parse_date(c, *formats)), F.lit(0))


def millis_year(c: Column | str) -> Column:
    """Calendar year of epoch milliseconds."""
    return F.year(F.timestamp_millis(as_column(c)))


def compare_dates(a: Column | str, b: Column | str, *formats: str) -> Column:
    """-1, 0 or 1 as ``a`` lies before, on or after ``b``; 0 when either is unreadable."""
    days = F.date_diff(parse_date(a, *formats), parse_date(b, *formats))
    return F.coalesce(F.signum(days).cast("int"), F.lit(0))


def week_start(d: Column | str) -> Column:
    """Monday that names the Sunday-to-Saturday week of ``d``."""
    return F.date_trunc("week", F.date_add(as_column(d), 1)).cast("date")


def week_label(c: Column | str, *formats: str) -> Column:
    """``year/ISO week`` of the following day, the older text key.

    It takes the calendar year with the ISO week number, so the days around a
    new year can share a label; ``week_start`` does not.
    """
    day = F.date_add(parse_date(c, *(formats or CONFORMED_FORMATS)), 1)
    label = F.concat(F.year(day).cast("string"), F.lit("/"), F.weekofyear(day).cast("string"))
    return F.coalesce(label, F.lit(UNPARSABLE_WEEK))


def saturday_of_week(d: Column | str) -> Column:
    """Saturday of the Monday-to-Sunday week of ``d``."""
    return F.date_add(F.date_trunc("week", as_column(d)).cast("date"), 5)


def saturday_on_or_before(d: Column | str) -> Column:
    d = as_column(d)
    return F.date_sub(d, F.pmod(F.weekday(d) - F.lit(5), F.lit(7)))


def short_date(d: Column | str) -> Column:
    """``M/d/yyyy`` without leading zeros."""
    return F.date_format(as_column(d), "M/d/yyyy")


class RunClock:
    """One moment for a whole run, so that a rerun can be given the same one."""

    def __init__(self, now: dt.datetime | None = None):
        self.now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)

    @property
    def day(self) -> str:
        return self.now.strftime("%Y%m%d")

    @property
    def millis(self) -> str:
        return str(int(self.now.replace(tzinfo=dt.timezone.utc).timestamp() * 1000))

    @property
    def timestamp(self) -> str:
        return self.now.strftime("%Y-%m-%d %H:%M:%S.%f")[:-3]

    @property
    def date(self) -> dt.date:
        return self.now.date()
