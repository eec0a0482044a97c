"""Counting a frame before deciding how to join it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from feedwright.functions.text import quoted
from feedwright.session import keep_folders_open, scratch_path


def text_bytes(names: Sequence[str]) -> Column:
    """Bytes that the columns of one row take as text."""
    sizes = [F.coalesce(F.octet_length(F.col(quoted(n)).cast("string")), F.lit(0)) for n in names]
    return reduce(lambda a, b: a + b, sizes)


def _size(names: Sequence[str]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(text_bytes(names).cast("bigint")), F.lit(0)).alias("bytes"),
    ]


def measure(frames: Sequence[DataFrame]) -> list[tuple[int, int]]:
    """Rows and bytes of each frame, all counted in one job."""
    if not frames:
        return []
    counted = [f.agg(*_size(f.columns)).withColumn("frame", F.lit(i)) for i, f in enumerate(frames)]
    found = {r["frame"]: (r["rows"], r["bytes"]) for r in reduce(DataFrame.union, counted).collect()}
    return [found[i] for i in range(len(frames))]


@dataclass
class Settled:
    """A frame written to the scratch folder, with what was counted on the way."""

    frame: DataFrame
    rows: int
    bytes: int
    metrics: dict[str, Any] = field(default_factory=dict)


def settle(
    df: DataFrame,
    purpose: str,
    metrics: Mapping[str, Column] | None = None,
    sized: bool = False,
    partition_by: Sequence[str] = (),
) -> Settled:
    """Write ``df`` once and read it back; later steps start from the files.

    The files lie in the shared scratch folder, so a lost executor costs its
    running tasks and not the work behind this point. Counts come from the same
    job, taken right before the write where no task result is counted twice.
    """
    spark = df.sparkSession
    seen = Observation()
    wanted = [F.count(F.lit(1)).alias("rows")]
    if sized:
        wanted = _size(df.columns)
    wanted += [c.alias(name) for name, c in (metrics or {}).items()]
    path = scratch_path(spark, purpose)
    writer = df.observe(seen, *wanted).write
    if partition_by:
        keep_folders_open(spark)
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    found = dict(seen.get)
    return Settled(
        spark.read.schema(df.schema).parquet(path),
        found.pop("rows"),
        found.pop("bytes", 0),
        found,
    )
