"""Foreign keys against master tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.functions.text import quoted
from feedwright.limits import DEFAULT_LIMITS, Limits
from feedwright.operators.joining import attach, shuffled
from feedwright.operators.schema import cols
from feedwright.operators.setops import distinct_rows
from feedwright.operators.sizing import Settled, measure, settle, text_bytes


@dataclass(frozen=True)
class Lookup:
    """A feed column that must be found in a master column.

    ``ignore_case`` compares upper-cased text; ``take_spelling`` then puts the
    master's spelling into the kept rows. If the master holds a text in several
    spellings, the smallest one is taken, so a lookup never multiplies rows.
    """

    column: str
    master: DataFrame
    key: str
    label: str = ""
    ignore_case: bool = False
    take_spelling: bool = False

    @property
    def text(self) -> str:
        return self.label or self.column


def _ok(i: int) -> str:
    return f"_ok{i}"


def _spelling(i: int) -> str:
    return f"_spelling{i}"


def _sides(df: DataFrame, lookup: Lookup) -> tuple[Column, Column]:
    """Feed and master key as comparable columns."""
    feed, master = F.col(quoted(lookup.column)), F.col(quoted(lookup.key))
    if df.schema[lookup.column].dataType != lookup.master.schema[lookup.key].dataType:
        feed, master = feed.cast("string"), master.cast("string")
    if lookup.ignore_case:
        feed, master = F.upper(feed), F.upper(master)
    return feed, master


def _master_keys(df: DataFrame, lookup: Lookup) -> DataFrame:
    """The master's keys as ``_k0``, with ``_word`` where the spelling is wanted."""
    _, key = _sides(df, lookup)
    picked = [key.alias("_k0")]
    if lookup.take_spelling:
        picked.append(F.col(quoted(lookup.key)).alias("_word"))
    return lookup.master.select(*picked).where("_k0 is not null")


def _unique(keys: DataFrame, lookup: Lookup) -> DataFrame:
    if lookup.take_spelling:
        return keys.groupBy("_k0").agg(F.min("_word").alias("_word"), F.lit(True).alias("_hit"))
    return keys.distinct().withColumn("_hit", F.lit(True))


def _feed_keys(source: DataFrame, feeds: Sequence[Column]) -> dict[str, Settled]:
    """The distinct keys of several feed columns, by the column's text, with their rows as ``_n``.

    One pass over the feed counts all columns of one type.
    """
    by_type: dict[str, dict[str, Column]] = {}
    for feed in feeds:
        by_type.setdefault(source.select(feed).schema[0].dataType.simpleString(), {})[str(feed)] = feed
    out = {}
    for same in by_type.values():
        pairs = F.array(*[F.struct(F.lit(i).alias("_i"), feed.alias("_k0")) for i, feed in enumerate(same.values())])
        keys = source.select(F.explode(pairs).alias("_p")).groupBy("_p._i", "_p._k0").agg(F.count(F.lit(1)).alias("_n"))
        frame = settle(keys, "feed-keys", partition_by=["_i"]).frame
        size = [F.count(F.lit(1)).alias("rows"), F.sum(text_bytes(["_k0"]).cast("bigint")).alias("bytes"), F.sum("_n").alias("members")]
        # One row per column.
        found = {r["_i"]: r for r in frame.groupBy("_i").agg(*size).collect()}
        for i, name in enumerate(same):
            own = frame.where(F.col("_i") == i).select("_k0", "_n")
            rows, taken, members = found[i][1:] if i in found else (0, 0, 0)
            out[name] = Settled(own, rows, taken, {"members": members})
    return out


def _attach_large(
    df: DataFrame, counted: Settled, lookup: Lookup, keys: DataFrame, feed: Column, limits: Limits
) -> DataFrame:
    """Look up in a master that is too large to broadcast.

    Only the distinct keys of the feed before any lookup, ``counted``, meet the
    master; they are narrow and combined before their shuffle. If they are few,
    the master is filtered by them where it lies. Otherwise the orphans go back
    to the wide rows by broadcast if those are few. Failing both, the rows of
    hot keys are split off and the rest is shuffled.
    """
    if limits.allow(counted.rows, counted.bytes):
        few = F.broadcast(counted.frame.select("_k0"))
        return attach(df, _unique(keys.join(few, "_k0", "left_semi"), lookup), [feed], small=True)
    known = _unique(keys, lookup).withColumnRenamed("_k0", "_m0")
    judged = settle(
        counted.frame.join(shuffled(known), F.col("_k0") == F.col("_m0"), "left").drop("_m0"), "key-verdicts"
    ).frame
    if not lookup.take_spelling:
        orphans = judged.where("_hit is null").select("_k0", F.lit(True).alias("_orphan"))
        (rows, size), = measure([orphans])
        if limits.allow(rows, size):
            out = attach(df, orphans, [feed], small=True, null_safe=True)
            return out.withColumn("_hit", F.col("_orphan").isNull()).drop("_orphan")
    hot = judged.where(F.col("_n") * limits.hot_share > counted.metrics["members"]).drop("_n")
    return attach(df, judged.drop("_n"), [feed], small=False, hot=hot, null_safe=True)


def flag_lookups(df: DataFrame, lookups: Sequence[Lookup], limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """``df`` with ``_ok0``, ``_ok1`` ... saying which lookups hold.

    Each lookup is tested for every row, whatever the others say. One frame of
    flags serves both the kept rows and the errors. A null key never holds.
    """
    masters = [_master_keys(df, lookup) for lookup in lookups]
    feeds, sizes = [_sides(df, lookup)[0] for lookup in lookups], measure(masters)
    counted = _feed_keys(df, [feed for feed, size in zip(feeds, sizes) if not limits.allow(*size)])
    for i, (lookup, keys, feed, size) in enumerate(zip(lookups, masters, feeds, sizes)):
        if limits.allow(*size):
            df = attach(df, _unique(keys, lookup), [feed], small=True)
        else:
            df = _attach_large(df, counted[str(feed)], lookup, keys, feed, limits)
        df = df.withColumn(_ok(i), F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit")
        if lookup.take_spelling:
            df = df.withColumnRenamed("_word", _spelling(i))
    return df


def all_hold(n: int) -> Column:
    """True when every one of ``n`` flagged lookups holds."""
    out = F.lit(True)
    for i in range(n):
        out = out & F.col(_ok(i))
    return out


def with_spelling(flagged: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Replace looked-up texts by the master's spelling."""
    words = {
        lookup.column: F.col(_spelling(i)) for i, lookup in enumerate(lookups) if lookup.take_spelling
    }
    return flagged.withColumns(words) if words else flagged


def kept_rows(flagged: DataFrame, lookups: Sequence[Lookup], columns: Sequence[str]) -> DataFrame:
    """Rows for which every lookup holds."""
    return with_spelling(flagged.where(all_hold(len(lookups))), lookups).select(*cols(columns))


def failed_labels(lookups: Sequence[Lookup]) -> Column:
    """Labels of the lookups that fail for a row."""
    labels = [F.when(~F.col(_ok(i)), F.lit(lookup.text)) for i, lookup in enumerate(lookups)]
    return F.array_compact(F.array(*labels))


def failing_rows(
    flagged: DataFrame, lookups: Sequence[Lookup], columns: Sequence[str], limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """Distinct rows for which some lookup fails, with their flags."""
    flags = [F.col(_ok(i)) for i in range(len(lookups))]
    return distinct_rows(flagged.where(~all_hold(len(lookups))).select(*cols(columns), *flags), limits)


def failed_rows(
    flagged: DataFrame, lookups: Sequence[Lookup], columns: Sequence[str], limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """Distinct rows per failed lookup, its label in ``_failed``."""
    # The flags follow from the row, so rows are made distinct before each of
    # them turns into one row per failed lookup.
    failed = failing_rows(flagged, lookups, columns, limits)
    return failed.select(*cols(columns), F.explode(failed_labels(lookups)).alias("_failed"))


def keep_known(df: DataFrame, lookup: Lookup, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Rows whose key is in the master; copies stay."""
    return kept_rows(flag_lookups(df, [lookup], limits), [lookup], df.columns)


def unknown_rows(df: DataFrame, lookup: Lookup, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Distinct rows whose key is null or not in the master."""
    return flag_lookups(df, [lookup], limits).where("not _ok0").select(*cols(df.columns)).distinct()
