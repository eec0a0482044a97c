"""Records of comma files whose quoted fields hold line breaks.

Files stay splittable: lines are read as Spark splits them, and whether a line
begins inside quotes follows from the number of quotes before it. Each split
gives the parity of its quotes and how many records it would begin if it opened
outside or inside quotes; prefix sums over a file's splits then say which of the
two holds, and number the records. Only lines of records that have several are
shuffled.

A file with an odd number of quotes, or with a record of more than ``MOST_LINES``
lines, has a stray quote: it is taken line by line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedwright.sources.files import delete_folder
from feedwright.sources.readers import read_lines
from feedwright.session import scratch_path

#: Lines that one record may have.
MOST_LINES = 20_000


def quote_parity(line: Column | str) -> Column:
    """1 where a line holds an odd number of double quotes."""
    line = F.col(line) if isinstance(line, str) else line
    quotes = F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit("")))
    return F.pmod(quotes, F.lit(2)).cast("bigint")


def numbered_lines(lines: DataFrame) -> DataFrame:
    """Lines with the number of their record in the file, and whether they begin it.

    ``lines`` has ``value``, ``path``, ``block`` (where the line's split begins) and
    ``at``, which orders the lines of a split.
    """
    # A window holds one split of a file.
    split = Window.partitionBy("path", "block")
    so_far = split.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    local = lines.withColumn("odd", quote_parity("value"))
    local = local.withColumn("inside", F.pmod(F.coalesce(F.sum("odd").over(so_far), F.lit(0)), F.lit(2)))
    upto = split.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = local.withColumns(
        {"as_closed": F.sum(F.lit(1) - F.col("inside")).over(upto), "as_open": F.sum("inside").over(upto)}
    )
    splits = local.groupBy("path", "block").agg(
        F.sum("odd").alias("quotes"), F.max("as_closed").alias("n_closed"), F.max("as_open").alias("n_open")
    )
    # As many rows of a file as it has splits.
    ahead = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("open", F.pmod(F.coalesce(F.sum("quotes").over(ahead), F.lit(0)), F.lit(2)))
    begun = F.when(F.col("open") == 0, F.col("n_closed")).otherwise(F.col("n_open"))
    splits = splits.withColumn("begun", begun)
    splits = splits.withColumn("first", F.coalesce(F.sum("begun").over(ahead), F.lit(0)))
    both = local.join(splits.select("path", "block", "open", "first"), ["path", "block"])
    own = F.when(F.col("open") == 0, F.col("as_closed")).otherwise(F.col("as_open"))
    return both.select(
        "path",
        "block",
        "at",
        "value",
        (F.col("first") + own).alias("record"),
        (F.pmod(F.col("inside") + F.col("open"), F.lit(2)) == 0).alias("begins"),
        "odd",
    )


def stray_quotes(numbered: DataFrame, most: int = MOST_LINES) -> DataFrame:
    """Paths of files that are better taken line by line."""
    records = numbered.groupBy("path", "record").agg(F.count(F.lit(1)).alias("lines"), F.sum("odd").alias("odd"))
    files = records.groupBy("path").agg(F.max("lines").alias("lines"), F.pmod(F.sum("odd"), F.lit(2)).alias("odd"))
    return files.where((F.col("lines") > most) | (F.col("odd") == 1)).select("path")


def read_records(spark: SparkSession, paths: Sequence[str], most: int = MOST_LINES) -> DataFrame:
    """path, record (its number in the file, from 1) and ``value``: each record with its line breaks; blank lines between are left out."""
    lines = read_lines(spark, paths).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )
    # Written, as several passes follow over lines that were numbered at some cost.
    folder = scratch_path(spark, "records")
    numbered_lines(lines).write.parquet(folder)
    numbered = spark.read.parquet(folder)
    stray = stray_quotes(numbered, most)
    marked = numbered.join(stray.withColumn("stray", F.lit(True)), "path", "left").withColumn("stray", F.col("stray").isNotNull())
    alone = F.col("stray") | (F.col("begins") & (F.col("odd") == 0))
    blank = F.trim("value") == ""
    # Line by line, a line's own place numbers it.
    number = F.when(F.col("stray"), F.col("block") + F.col("at")).otherwise(F.col("record"))
    single = marked.where(alone & ~blank).select("path", number.alias("record"), "value")
    parts = marked.where(~alone).groupBy("path", "record").agg(F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("parts"))
    joined = F.array_join(F.transform("parts", lambda p: p["value"]), "\n")
    return single.unionByName(parts.select("path", "record", joined.alias("value")))


def parsed(records: DataFrame, names: Sequence[str], *kept: str) -> DataFrame:
    """Records as text columns by position; short ones are filled with nulls, long ones cut."""
    fields = F.from_csv("value", ", ".join(f"f{i} string" for i in range(len(names))), {"escape": '"', "mode": "PERMISSIVE"})
    out = records.withColumn("_fields", fields)
    return out.select(*kept, *[F.col(f"_fields.f{i}").alias(n) for i, n in enumerate(names)])
