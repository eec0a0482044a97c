"""Listing and switching folders on whatever file system the path names."""

from __future__ import annotations

import fnmatch
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


@dataclass(frozen=True)
class File:
    path: str
    name: str
    size: int = 0


def glob_files(spark: SparkSession, pattern: str, exclude: Sequence[str] = ()) -> list[File]:
    """Files matching ``pattern``, sorted, without those whose name fits an ``exclude`` pattern."""
    found = _system(spark, pattern).globStatus(_path(spark, pattern)) or []
    files = [File(s.getPath().toString(), s.getPath().getName(), s.getLen()) for s in found]
    return sorted(
        (f for f in files if not any(fnmatch.fnmatch(f.name, x) for x in exclude)), key=lambda f: f.path
    )


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; none when it is missing."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _system(spark, path).listStatus(_path(spark, path)))


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Give a file another name on the same file system; folders on the way are made."""
    system = _system(spark, source)
    system.mkdirs(_path(spark, target.rsplit("/", 1)[0]))
    if system.exists(_path(spark, target)) or not system.rename(_path(spark, source), _path(spark, target)):
        raise FileExistsError(target)


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Remove a folder this library wrote. Input files are never deleted."""
    return _system(spark, path).delete(_path(spark, path), True)


def read_text(spark: SparkSession, path: str) -> str:
    """The whole of a small UTF-8 file."""
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small UTF-8 file that is seen as a whole or not at all; a file of that name is never replaced."""
    system, target = _system(spark, path), _path(spark, path)
    if system.exists(target):
        raise FileExistsError(path)
    folder, name = path.rsplit("/", 1)
    hidden = _path(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    stream = system.create(hidden, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not system.rename(hidden, target):
        system.delete(hidden, False)
        raise FileExistsError(path)
