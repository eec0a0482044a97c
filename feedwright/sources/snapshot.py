"""The accumulated table of one dataset.

Layout: rows lie in ``<root>/v=<version>/w=<write>/[<partition>=<value>/]``, and the
newest commit below ``<root>/_log`` lists the folders that are current (see
``commits``). A table is partitioned in one of four ways:

* by a real date (``day``): a restatement writes the dates it covers;
* by buckets of its keys (``keys``): an upsert rewrites the buckets its keys fall in;
* by buckets of whole rows (``hashed``), with a fingerprint beside each row: an
  append reads fingerprints of the buckets it touches, and whole rows only where
  fingerprints meet;
* not at all.

Rows and dates of every partition stand in the commit, so counts and coverage
need no data file.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedwright.limits import DEFAULT_LIMITS, Limits
from feedwright.operators.joining import key_columns, same_keys
from feedwright.operators.schema import cols, text_schema
from feedwright.operators.setops import distinct_rows
from feedwright.operators.sizing import settle
from feedwright.sources.commits import Commit, CommitLog, Entry, bins
from feedwright.sources.files import delete_folder, list_names
from feedwright.sources.readers import empty_frame

PARTITION = "snapshot_date"
BUCKET = "snapshot_bucket"
FINGERPRINT = "snapshot_fingerprint"
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: Rows that a hash bucket is laid out for; a table twice as full is dealt anew.
BUCKET_ROWS = 500_000
#: Buckets, which are folders, that a table has at most; beyond these they hold more rows each.
MOST_BUCKETS = 512
#: Bytes of a file that compaction aims at.
FILE_BYTES = 128 << 20


def fingerprint(names: Sequence[str]) -> Column:
    """64 bits over all values of a row, nulls told apart from blanks."""
    return F.xxhash64(*[F.coalesce(F.concat(F.lit("="), c), F.lit("")) for c in cols(names)])


class Snapshot:
    """Versions of one dataset's table below ``root``."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        names: Sequence[str],
        day: Column | None = None,
        keys: Sequence[str] = (),
        hashed: bool = False,
        bucket_rows: int = BUCKET_ROWS,
        of_row: Callable[[Sequence[str]], Column] = fingerprint,
    ):
        if (day is not None) + bool(keys) + hashed > 1:
            raise ValueError("a snapshot is partitioned by date, by keys or by rows, not by several of them")
        self.spark = spark
        self.root = root.rstrip("/")
        self.names = list(names)
        self.day, self.keys, self.hashed = day, list(keys), hashed
        self.bucket_rows, self.of_row = bucket_rows, of_row
        self.log = CommitLog(spark, self.root)

    # --- what is there -----------------------------------------------------

    def _folder(self, version: int) -> str:
        return f"{self.root}/v={version}"

    @property
    def _partition(self) -> str | None:
        return PARTITION if self.day is not None else BUCKET if self.keys or self.hashed else None

    @property
    def _schema(self) -> T.StructType:
        schema = text_schema(self.names)
        if self.hashed:
            schema = schema.add(FINGERPRINT, T.LongType())
        if self._partition:
            schema = schema.add(self._partition, T.DateType() if self.day is not None else T.IntegerType())
        return schema

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        return sorted({int(n.split(".")[0]) for n in self.log.names()})

    def current(self) -> str | None:
        versions = self.versions()
        return self._folder(versions[-1]) if versions else None

    def _scan(self, commit: Commit, entries: Sequence[Entry]) -> DataFrame:
        """Rows of some entries with the partition column; no other folder is listed."""
        paths = [f"{self._folder(commit.version)}/{e.path}" for e in entries if e.files]
        if not paths:
            return self.spark.createDataFrame([], self._schema)
        reader = self.spark.read.schema(self._schema).option("basePath", self._folder(commit.version))
        return reader.parquet(*paths).select(*cols(self._schema.names))

    def read(self) -> DataFrame:
        """All rows as of the newest commit, or an empty frame before the first write."""
        commit = self.log.newest()
        if commit is None:
            return empty_frame(self.spark, self.names)
        return self._scan(commit, commit.entries).select(*cols(self.names))

    def read_dates(self, lo: dt.date, hi: dt.date) -> DataFrame:
        """Rows of a date range; only those partitions are listed and read."""
        commit = self.log.newest()
        if commit is None or self.day is None:
            return self.read().where(self.day.between(F.lit(lo), F.lit(hi)))
        inside = [e for e in commit.entries if e.part is not None and str(lo) <= e.part <= str(hi)]
        scan = self._scan(commit, inside)
        return scan.where(F.col(PARTITION).between(F.lit(lo), F.lit(hi))).select(*cols(self.names))

    def partition_rows(self) -> dict[str | None, int]:
        """Rows of every partition value, from the newest commit alone."""
        commit, out = self.log.newest(), {}
        for e in commit.entries if commit else ():
            out[e.part] = out.get(e.part, 0) + e.rows
        return out

    # --- writing -----------------------------------------------------------

    def _bucket(self, buckets: int) -> Column:
        of = F.xxhash64(*cols(self.keys)) if self.keys else F.col(FINGERPRINT)
        return F.pmod(of, F.lit(buckets)).cast("int")

    def _laid_out(self, df: DataFrame, buckets: int) -> DataFrame:
        """``df`` with its partition column, gathered by it."""
        if self.day is not None:
            df = df.select(*cols(self.names), self.day.alias(PARTITION))
        else:
            df = df.select(*cols(self.names))
            if self.hashed:
                df = df.withColumn(FINGERPRINT, self.of_row(self.names))
            if self._partition:
                df = df.withColumn(BUCKET, self._bucket(buckets))
        # Rebalancing gathers a partition's rows into few files and, unlike a plain
        # repartition, splits a partition that is much larger than the others.
        return df.hint("rebalance", self._partition) if self._partition else df

    def _write(self, laid_out: DataFrame, version: int) -> list[Entry]:
        """Rows in a folder of their own; nothing refers to it yet."""
        write = f"w={uuid.uuid4().hex}"
        folder = f"{self._folder(version)}/{write}"
        laid_out.write.partitionBy(*([self._partition] if self._partition else [])).parquet(folder)
        return self._entries(folder, write)

    def _entries(self, folder: str, write: str) -> list[Entry]:
        """The partitions of a fresh write with rows, bytes and files; footers are read, no column is."""
        part = F.col(self._partition).cast("string") if self._partition else F.lit(None).cast("string")
        scan = self.spark.read.schema(self._schema).parquet(folder)
        files = scan.groupBy(part.alias("part"), "_metadata.file_path", "_metadata.file_size").agg(F.count(F.lit(1)).alias("rows"))
        parts = files.groupBy("part").agg(F.sum("rows").alias("rows"), F.sum("file_size").alias("bytes"), F.count(F.lit(1)).alias("files"))
        found = {r["part"]: r for r in parts.collect()}
        if not self._partition:
            r = found.get(None)
            return [Entry(write, None, r["rows"], r["bytes"], r["files"])] if r else []
        named = [(f"{write}/{self._partition}={_NO_VALUE if p is None else p}", p) for p in found]
        return [Entry(path, p, found[p]["rows"], found[p]["bytes"], found[p]["files"]) for path, p in sorted(named)]

    def _next(self, old: Commit, entries: Sequence[Entry]) -> str:
        self.log.write(Commit(old.version, old.number + 1, tuple(entries), old.buckets))
        return self._folder(old.version)

    def replace(self, df: DataFrame, rows: int | None = None) -> str:
        """Write ``df`` as the next version; it may read the current one. ``rows`` sizes the buckets."""
        taken = [int(n[2:]) for n in list_names(self.spark, self.root) if n.startswith("v=")]
        version = max([*taken, *self.versions()], default=0) + 1
        buckets = 0
        if self._partition == BUCKET:
            # Counted where the caller does not know; the number only sizes the buckets.
            wanted = -(-(df.count() if rows is None else rows) // self.bucket_rows)
            buckets = max(1, min(wanted, MOST_BUCKETS))
        entries = self._write(self._laid_out(df, buckets), version)
        self.log.write(Commit(version, 0, tuple(entries), buckets))
        return self._folder(version)

    def append(self, df: DataFrame) -> str:
        """Add rows to the current version; nothing already there is rewritten."""
        old = self.log.newest()
        if old is None:
            return self.replace(df)
        return self._next(old, [*old.entries, *self._write(self._laid_out(df, old.buckets), old.version)])

    def replace_dates(self, clean: DataFrame, lo: dt.date | None, hi: dt.date | None) -> str | None:
        """Restate the dates from ``lo`` to ``hi`` with ``clean``, in one commit.

        Delivered dates are written, all other entries inside the range are no
        longer listed, the rest stays. Running the same delivery again gives the
        same table.
        """
        if lo is None or hi is None:
            return self.current()
        old = self.log.newest()
        if old is None:
            return self.replace(distinct_rows(clean))
        fresh = self._write(self._laid_out(distinct_rows(clean), old.buckets), old.version)
        return self._next(old, [*(e for e in old.entries if e.part is None or not str(lo) <= e.part <= str(hi)), *fresh])

    def _outgrown(self, old: Commit, rows: int) -> bool:
        return old.buckets < MOST_BUCKETS and old.rows + rows > 2 * max(1, old.buckets) * self.bucket_rows

    def _touched(self, dealt: DataFrame, old: Commit) -> tuple[list[Entry], list[int]]:
        """Entries whose bucket occurs in ``dealt``, and these buckets: at most as many as the table has."""
        found = sorted(r[0] for r in dealt.select(BUCKET).distinct().collect())
        return [e for e in old.entries if e.part is not None and int(e.part) in set(found)], found

    def upsert(self, clean: DataFrame, rows: int, limits: Limits = DEFAULT_LIMITS) -> str | None:
        """Rows of ``clean`` (keys unique, ``rows`` of them) replace those of their keys; only their buckets are rewritten."""
        from feedwright.operators.merge import without_keys

        if not rows:
            return self.current()
        old = self.log.newest()
        if old is None or self._outgrown(old, rows):
            history = self.read() if old else empty_frame(self.spark, self.names)
            kept = without_keys(history, clean, self.keys, limits)
            return self.replace(kept.unionByName(clean.select(*cols(self.names))), (old.rows if old else 0) + rows)
        dealt = clean.select(*cols(self.names)).withColumn(BUCKET, self._bucket(old.buckets))
        touched, found = self._touched(dealt, old)
        history = self._scan(old, touched).where(F.col(BUCKET).isin(found)).select(*cols(self.names))
        merged = without_keys(history, clean, self.keys, limits).unionByName(clean.select(*cols(self.names)))
        fresh = self._write(self._laid_out(merged, old.buckets), old.version)
        gone = {e.path for e in touched}
        return self._next(old, [*(e for e in old.entries if e.path not in gone), *fresh])

    def new_rows(self, clean: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
        """Distinct rows of ``clean`` that the table lacks.

        Fingerprints of the touched buckets are read; whole rows only where a
        fingerprint of ``clean`` occurs among them.
        """
        clean = distinct_rows(clean.select(*cols(self.names)), limits)
        old = self.log.newest()
        if old is None:
            return clean
        dealt = clean.withColumn(FINGERPRINT, self.of_row(self.names)).withColumn(BUCKET, self._bucket(old.buckets))
        # Written, as buckets, fingerprints and rows of it are all asked for.
        dealt = settle(dealt, "new-rows").frame
        touched, found = self._touched(dealt, old)
        past = self._scan(old, touched).where(F.col(BUCKET).isNotNull() & F.col(BUCKET).isin(found))
        met = past.select(FINGERPRINT).join(dealt.select(FINGERPRINT).distinct(), FINGERPRINT, "left_semi").distinct()
        alike = dealt.join(met, FINGERPRINT, "left_semi").select(*cols(self.names))
        rows = past.join(met, FINGERPRINT, "left_semi").select(*key_columns(self.names))
        differ = alike.join(rows, same_keys(cols(self.names), null_safe=True), "left_anti")
        return dealt.join(met, FINGERPRINT, "left_anti").select(*cols(self.names)).unionByName(differ)

    def append_new(self, clean: DataFrame, rows: int, limits: Limits = DEFAULT_LIMITS) -> str | None:
        """Add the distinct rows that the table lacks; ``rows`` bounds their number."""
        if not rows:
            return self.current()
        old = self.log.newest()
        fresh = self.new_rows(clean, limits)
        if old is not None and self._outgrown(old, rows):
            return self.replace(self.read().unionByName(fresh), old.rows + rows)
        return self.replace(fresh, rows) if old is None else self.append(fresh)

    # --- upkeep ------------------------------------------------------------

    def compact(self, target: int = FILE_BYTES) -> int:
        """Write small files of one partition as one, in one commit; the number of files that went.

        Each planned group becomes one task's rows, so groups are bounded by ``target`` bytes.
        """
        old = self.log.newest()
        plan = bins(old.entries, target) if old else []
        if not plan:
            return 0
        # One row per small folder: as many as the commit lists.
        number = {f"{self._folder(old.version)}/{e.path}": i for i, group in enumerate(plan) for e in group}
        mapping = self.spark.createDataFrame([(p.rsplit("/w=", 1)[1], n) for p, n in number.items()], "folder string, bin int")
        picked = self._scan_files(old, [e for group in plan for e in group]).join(F.broadcast(mapping), "folder")
        dealt = picked.repartition(len(plan), "bin").sortWithinPartitions("bin").drop("folder", "bin")
        fresh = self._write(dealt, old.version)
        gone = {e.path for group in plan for e in group}
        self._next(old, [*(e for e in old.entries if e.path not in gone), *fresh])
        return sum(e.files for group in plan for e in group) - sum(e.files for e in fresh)

    def _scan_files(self, commit: Commit, entries: Sequence[Entry]) -> DataFrame:
        """Rows of some entries with ``folder``, the part of their path behind ``w=``."""
        paths = [f"{self._folder(commit.version)}/{e.path}" for e in entries]
        reader = self.spark.read.schema(self._schema).option("basePath", self._folder(commit.version))
        folder = F.regexp_extract(F.col("_metadata.file_path"), "/w=([^/]+(?:/[^/]+=[^/]+)?)/[^/]+$", 1)
        return reader.parquet(*paths).select(*cols(self._schema.names), folder.alias("folder"))

    def prune(self, keep: int = 2) -> list[str]:
        """Remove all but the ``keep`` newest commits, and the folders that none of these lists.

        For the one writer of the table: a write of another one that is not yet committed would go too.
        """
        names = self.log.names()
        kept = names[-keep:] if keep else names
        if not kept:
            return []
        listed = {(c.version, e.path.split("/")[0]) for c in map(self.log.read, kept) for e in c.entries}
        versions = {int(n.split(".")[0]) for n in kept}
        # The commits go first, so that nobody resolves one whose folders are about to go.
        for name in set(names) - set(kept):
            delete_folder(self.spark, f"{self.log.folder}/{name}.json")
        removed = []
        for v in sorted(int(n[2:]) for n in list_names(self.spark, self.root) if n.startswith("v=")):
            folder = self._folder(v)
            if v in versions:
                removed += [f"{folder}/{n}" for n in list_names(self.spark, folder) if (v, n) not in listed]
            else:
                removed.append(folder)
        for folder in removed:
            delete_folder(self.spark, folder)
        return removed

    def tidy(self, keep: int = 5, most: int = 64) -> None:
        """After a run: compact once there are ``most`` small folders, then prune."""
        newest = self.log.newest()
        if newest and sum(len(group) for group in bins(newest.entries, FILE_BYTES)) >= most:
            self.compact()
        self.prune(keep)
