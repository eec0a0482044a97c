"""The commit log of a table: which folders hold its rows.

A table is the folders that its newest commit lists. Data is written first, to
a folder of its own, and nothing of it is seen before the commit file is there;
folders are never written again afterwards. So a write that breaks leaves the
table as it was, and a reader keeps the state it has resolved.

Commits are named ``<version>.<number>``: a full rewrite starts a version, every
other change is the next number of the version. A commit lists one entry for
each partition folder with its rows, bytes and files; these are as many as a
table has partitions and open appends, and ``bins`` plans how to bring small
ones together.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

from feedwright.sources.files import list_names, read_text, write_text

LOG = "_log"


@dataclass(frozen=True)
class Entry:
    """One folder of rows, below the folder of its version; ``part`` is its partition value, None where null or absent."""

    path: str
    part: str | None
    rows: int
    bytes: int
    files: int


@dataclass(frozen=True)
class Commit:
    version: int
    number: int
    entries: tuple[Entry, ...]
    #: Hash buckets of the version; 0 where it has none.
    buckets: int = 0

    @property
    def rows(self) -> int:
        return sum(e.rows for e in self.entries)

    @property
    def name(self) -> str:
        return f"{self.version:09}.{self.number:09}"


class CommitLog:
    """The commits below ``<root>/_log``. One writer at a time; any number of readers."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, f"{root}/{LOG}"

    def names(self) -> list[str]:
        return [n.removesuffix(".json") for n in list_names(self.spark, self.folder) if n.endswith(".json")]

    def read(self, name: str) -> Commit:
        found = json.loads(read_text(self.spark, f"{self.folder}/{name}.json"))
        return Commit(**found | {"entries": tuple(Entry(**e) for e in found["entries"])})

    def newest(self) -> Commit | None:
        names = self.names()
        return self.read(names[-1]) if names else None

    def write(self, commit: Commit) -> Commit:
        """Make ``commit`` the newest; refused where another writer was faster."""
        text = json.dumps(asdict(commit))
        write_text(self.spark, f"{self.folder}/{commit.name}.json", text)
        return commit


def bins(entries: Iterable[Entry], target: int) -> list[list[Entry]]:
    """Groups of small entries of one partition whose files fill up one file of ``target`` bytes.

    Larger entries come first and each goes into the first group with room.
    Groups of a single entry of a single file are left out: rewriting them gains nothing.
    """
    groups: list[tuple[str | None, int, list[Entry]]] = []
    open_by_part: dict[str | None, list[int]] = {}
    small = [e for e in entries if e.files > 0 and e.bytes / e.files < target / 2]
    for e in sorted(small, key=lambda e: (-e.bytes, e.path)):
        at = next((i for i in open_by_part.get(e.part, ()) if groups[i][1] + e.bytes <= target), None)
        if at is None:
            open_by_part.setdefault(e.part, []).append(len(groups))
            groups.append((e.part, e.bytes, [e]))
        else:
            part, size, members = groups[at]
            groups[at] = (part, size + e.bytes, [*members, e])
    return [members for _, _, members in groups if sum(e.files for e in members) > 1]
