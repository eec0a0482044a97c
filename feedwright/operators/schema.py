"""Declared schemas and header checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import zip_longest

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedwright.functions.text import as_column, quoted


def split_names(text: str) -> list[str]:
    return text.split(",")


def text_schema(names: str | Sequence[str]) -> T.StructType:
    """Nullable text columns, from a comma-joined string or a list."""
    if isinstance(names, str):
        names = split_names(names)
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def normalise_names(names: Sequence[str]) -> list[str]:
    """Trimmed, with blanks as underscores."""
    return [n.strip().replace(" ", "_") for n in names]


def compare_width(declared: int, found: int) -> str | None:
    """What is wrong with the number of columns, or None."""
    if found < declared:
        return f"LESS: {found} columns, {declared} declared"
    if found > declared:
        return f"MORE: {found} columns, {declared} declared"
    return None


def names_missing(wanted: Sequence[str], present: Sequence[str]) -> list[str]:
    """Names of ``wanted`` that ``present`` lacks, in order."""
    have = set(present)
    return [n for n in wanted if n not in have]


def out_of_order(declared: Sequence[str], found: Sequence[str]) -> list[str]:
    """Declared names whose position holds another name."""
    return [d for d, f in zip_longest(declared, found) if d is not None and d != f]


@dataclass(frozen=True)
class HeaderVerdict:
    valid: bool
    width: str | None
    missing: list[str]
    extra: list[str]
    misplaced: list[str]


def check_header(declared: Sequence[str], found: Sequence[str]) -> HeaderVerdict:
    """Same width, same names, same order, blanks and underscores being equal."""
    declared, found = normalise_names(declared), normalise_names(found)
    width = compare_width(len(declared), len(found))
    missing = names_missing(declared, found)
    extra = names_missing(found, declared)
    misplaced = out_of_order(declared, found)
    return HeaderVerdict(not (width or missing or extra or misplaced), width, missing, extra, misplaced)


def field_count(line: Column | str, delimiter: str = "|") -> Column:
    """Fields in a delimited line: its delimiters plus one."""
    line = as_column(line)
    without = F.replace(line, F.lit(delimiter), F.lit(""))
    return ((F.octet_length(line) - F.octet_length(without)) / F.lit(len(delimiter.encode()))).cast("int") + F.lit(1)


def rebind(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same columns by position under the declared names."""
    return df.toDF(*names)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def add_helper(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.withColumn(name, value)


def drop_helpers(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def column(df: DataFrame, name: str) -> str:
    """The feed's own spelling of ``name``, found without regard to case."""
    for c in df.columns:
        if c.lower() == name.lower():
            return c
    raise KeyError(f"no column {name!r} in {df.columns}")


def cols(names: Sequence[str]) -> list[Column]:
    return [F.col(quoted(n)) for n in names]
