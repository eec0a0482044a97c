"""Increments, errors, manifests and split tables on storage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.functions.text import strip_line_quotes


def write_increment(df: DataFrame, root: str, run_id: str) -> str:
    """Clean rows of one run. Writing the same run again replaces it."""
    path = f"{root}/run_id={run_id}"
    df.write.mode("overwrite").parquet(path)
    return path


def run_path(root: str, dataset: str, run_id: str) -> str:
    """Where a run's manifest or records of one dataset lie."""
    return f"{root}/dataset={dataset}/run_id={run_id}"


def write_errors(records: DataFrame, root: str, day: str, dataset: str, run_id: str) -> str:
    """Error records of one run, below ``<root>/dataset=<dataset>/run_id=<run>``; the same run replaces them."""
    path = run_path(root, dataset, run_id)
    records.withColumn("run_date", F.lit(day)).write.mode("overwrite").parquet(path)
    return path


def write_manifest(manifest: DataFrame, root: str, day: str, dataset: str, run_id: str) -> None:
    """The manifest of one run; the same run replaces it."""
    manifest.withColumn("run_date", F.lit(day)).write.mode("overwrite").parquet(run_path(root, dataset, run_id))


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """Comma files with a header line, as many as the frame has partitions."""
    df.write.mode(mode).partitionBy(*partition_by).csv(path, header=True, escape='"', emptyValue="")


def write_lines(lines: DataFrame, path: str) -> None:
    """Text lines without double quotes."""
    lines.select(strip_line_quotes("value").alias("value")).write.text(path)


def write_split(df: DataFrame, path: str, by: str = "bucket") -> None:
    """One folder per bucket, in one pass."""
    df.hint("rebalance", by).write.partitionBy(by).parquet(path)


def write_per_file(df: DataFrame, path: str, file_col: str = "file") -> None:
    """One folder per delivered file, replaced when the file is delivered again."""
    (
        df.hint("rebalance", file_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(file_col)
        .parquet(path)
    )
