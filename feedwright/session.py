"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import SparkSession

# What every run relies on: one time zone, ANSI errors instead of silent nulls,
# run-time re-planning, and partition overwrite limited to delivered dates.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "feedwright", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the library's settings; ``settings`` use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"feedwright-{application}-")


#: Partition folders that a task keeps open while it writes.
OPEN_FOLDERS = "8"


def keep_folders_open(spark: SparkSession) -> None:
    """Let tasks write to a few partition folders at a time, instead of sorting all their rows by folder first.

    A task with more folders sorts what is left. A session that was told otherwise keeps its setting.
    """
    if spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == "0":
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", OPEN_FOLDERS)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; on
    a cluster a machine-local folder would vanish with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_folder(spark.sparkContext.applicationId)


_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the scratch folder of the current run, or below the root."""
    folder = _run_folder.get() or f"{scratch_root(spark)}/feedwright"
    return f"{folder}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """Keep all scratch tables of a block in one folder and remove it at the end.

    Frames that read those tables must not be used after the block.
    """
    from feedwright.sources.files import delete_folder

    folder = scratch_path(spark, "run")
    token = _run_folder.set(folder)
    try:
        yield folder
    finally:
        _run_folder.reset(token)
        delete_folder(spark, folder)
