"""What there is to say about one feed."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from functools import partial, reduce
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.functions.dates import CONFORMED_FORMATS, reformat_date
from feedwright.functions.text import pad_code, pad_whole, quoted, strip_chars
from feedwright.operators.rules import any_present, bad_key, planogram_rule
from feedwright.operators.schema import normalise_names, split_names

# A change to one column: its name and a function from column to column.
Step = tuple[str, Callable[[Column], Column]]


def pad(name: str, width: int, cut: bool = True) -> Step:
    """Zeros in front up to ``width``. Without ``cut`` longer codes stay, for ``FeedSpec.longest`` to refuse."""
    return name, partial(pad_code if cut else pad_whole, width=width)


def without(name: str, chars: str) -> Step:
    return name, partial(strip_chars, chars=chars)


def dates(formats: tuple[str, ...], *names: str) -> tuple[Step, ...]:
    return tuple((n, lambda c: reformat_date(c, *formats)) for n in names)


def apply_steps(df: DataFrame, steps: tuple[Step, ...], where: Column | None = None) -> DataFrame:
    """All steps as one projection; several steps on a column run in order."""
    changed: dict[str, Column] = {}
    for name, change in steps:
        changed[name] = change(changed.get(name, F.col(quoted(name))))
    if where is not None:
        changed = {n: F.when(where, c).otherwise(F.col(quoted(n))) for n, c in changed.items()}
    return df.withColumns(changed) if changed else df


@dataclass(frozen=True)
class LookupSpec:
    """``column`` must occur as ``key`` in the snapshot of ``dataset``."""

    column: str
    dataset: str
    key: str
    label: str = ""
    ignore_case: bool = False


@dataclass(frozen=True)
class FeedSpec:
    """One feed, from raw file to snapshot.

    ``before`` runs ahead of the key rule and ``after`` behind it, on passing
    rows only: padding a key first hides a blank, upper-casing it first changes
    what counts as repeated. A code longer than ``longest`` allows is a bad key. ``columns`` is empty for the widest feeds, whose
    names come from a schema file; ``width`` is known for all.
    """

    name: str
    raw_glob: str
    width: int
    merge: Literal["append", "upsert", "range", "file"]
    columns: tuple[str, ...] = ()
    output: str = ""
    exclude: tuple[str, ...] = ()
    piped: bool = False
    before: tuple[Step, ...] = ()
    keys: tuple[str, ...] = ()
    date_keys: tuple[str, ...] = ()
    measures: tuple[str, ...] = ()
    longest: tuple[tuple[str, int], ...] = ()
    key_rule: Literal["all", "any"] = "all"
    key_text: str = ""
    after: tuple[Step, ...] = ()
    unique: tuple[str, ...] = ()
    distinct_dups: bool = False
    lookups: tuple[LookupSpec, ...] = ()
    lookup_text: str = ""
    range_date: str = ""
    distinct_errors: bool = False
    conform_history: bool = False

    @property
    def output_name(self) -> str:
        return self.output or self.name

    @property
    def row_columns(self) -> list[str]:
        """Names during a run: per-file feeds go by their staged header, others by the declared one."""
        return normalise_names(self.columns) if self.merge == "file" else list(self.columns)

    @property
    def is_fact(self) -> bool:
        return self.merge == "range"

    @property
    def key_names(self) -> str:
        return self.key_text or ",".join(self.keys)

    def with_columns(self, names: str | list[str] | tuple[str, ...]) -> FeedSpec:
        names = tuple(split_names(names) if isinstance(names, str) else names)
        if len(names) != self.width:
            raise ValueError(f"{self.name}: {len(names)} columns given, {self.width} declared")
        return replace(self, columns=names)

    def check_columns(self) -> None:
        if not self.columns:
            raise ValueError(f"{self.name}: its {self.width} columns must come from a schema file")

    def bad(self) -> Column:
        """Rows reported for their keys. Never null."""
        if self.measures:
            filled = [k for k in self.keys if k not in self.measures]
            return planogram_rule(filled, self.measures, string_order=True)
        too_long = [F.coalesce(F.length(quoted(c)) > n, F.lit(False)) for c, n in self.longest]
        bad = bad_key(self.keys, self.date_keys) if self.keys else F.lit(False)
        return reduce(Column.__or__, too_long, bad)

    def passes(self) -> Column:
        """Rows that go on. With ``key_rule='any'`` one filled key is enough."""
        return any_present(self.keys) if self.key_rule == "any" else ~self.bad()

    def day(self) -> Column:
        """The conformed restatement date."""
        from feedwright.operators.merge import feed_day

        return feed_day(self.range_date, CONFORMED_FORMATS)


def read_schemas(lines: list[str]) -> dict[str, str]:
    """``dataset = column,column,...`` lines; blank lines and ``#`` lines are skipped."""
    out = {}
    for line in lines:
        if line.strip() and not line.lstrip().startswith("#"):
            name, _, columns = line.partition("=")
            out[name.strip()] = columns.strip()
    return out


def fill_schemas(specs: Mapping[str, FeedSpec], schemas: Mapping[str, str]) -> dict[str, FeedSpec]:
    """Specs with the column names of a schema file; names already known give way to it."""
    return {n: s.with_columns(schemas[n]) if n in schemas else s for n, s in specs.items()}
