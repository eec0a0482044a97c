"""Scans of feeds, masters and history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.operators.schema import cols, text_schema
from feedwright.operators.setops import distinct_keys
from feedwright.sources.files import exists


def read_typed_csv(
    spark: SparkSession, path: str | Sequence[str], names: str | Sequence[str], nested: bool = False
) -> DataFrame:
    """Comma feed with a header line; columns are bound by position as text.

    Short rows are filled with nulls, long rows are cut. ``nested`` also reads
    the folders below ``path``.
    """
    return spark.read.csv(
        path,
        schema=text_schema(names),
        header=True,
        escape='"',
        mode="PERMISSIVE",
        enforceSchema=True,
        recursiveFileLookup=nested,
    )


def read_headed_csv(spark: SparkSession, path: str | Sequence[str], delimiter: str = ",") -> DataFrame:
    """Feed whose column names come from its header; everything is text."""
    return spark.read.csv(path, header=True, sep=delimiter, escape='"', inferSchema=False)


def read_piped(
    spark: SparkSession, path: str | Sequence[str], names: str | Sequence[str], nested: bool = False
) -> DataFrame:
    """Pipe feed without a header line."""
    return spark.read.csv(
        path, schema=text_schema(names), header=False, sep="|", recursiveFileLookup=nested
    )


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One ``value`` column, a row per line."""
    return spark.read.text(path)


def file_name() -> Column:
    """Name of the file a row came from; use it right after the scan."""
    return F.col("_metadata.file_name")


def rows_per_file(df: DataFrame) -> DataFrame:
    """Row count of every scanned file, in one job; ``df`` must be a fresh scan."""
    return df.groupBy(file_name().alias("file")).agg(F.count(F.lit(1)).alias("rows"))


def master_keys(master: DataFrame, key: str) -> DataFrame:
    """The distinct keys of a master table; only that column is read."""
    return distinct_keys(master, [key])


def empty_frame(spark: SparkSession, names: str | Sequence[str]) -> DataFrame:
    return spark.createDataFrame([], text_schema(names))


def read_history(
    spark: SparkSession, path: str, names: str | Sequence[str], fmt: str = "parquet"
) -> DataFrame:
    """Accumulated rows at ``path``, or an empty frame before the first run."""
    if not exists(spark, path):
        return empty_frame(spark, names)
    if fmt == "csv":
        return read_typed_csv(spark, path, names)
    schema = text_schema(names)
    return spark.read.schema(schema).parquet(path).select(*cols(schema.names))
