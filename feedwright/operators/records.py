"""Error records, verdicts and run manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedwright.functions.text import row_text
from feedwright.operators.schema import cols

# The four kinds of error text, spelled as downstream reports know them.
BAD_KEY = "Columns: {} is not proper(null/blank/0/Unparceable)"
DUPLICATE = "Columns: {} is Duplicate in data"
LOOKUP = "Column: {} Referential Validation Failed"
FACT_LOOKUP = "Refrential Integrity failed at column: {}"

# Statuses and descriptions of the manifests.
PROCESSED = "Processed"
REJECTED = "Rejected"
FAILED = "Exception Occured while Processing"
NO_REMARK = "NA"
RAGGED = "{} lines with too few or too many fields"
BAD_SCHEMA = "Schema validation failed"
NO_FILE = "File Not Found"
NOT_PLACED = "File Renameing Failed / File already present in Stage"
CHANGED = "File already present in Stage, changed since"

ERROR_COLUMNS = ["Data_Set_Name", "Error_Description", "Error_Record", "Insert_Time"]

RUN_MANIFEST = T.StructType(
    [
        T.StructField("Data_Set_Name", T.StringType()),
        T.StructField("Status", T.StringType()),
        T.StructField("No_Of_records_received", T.LongType()),
        T.StructField("No_Of_records_rejected", T.LongType()),
        T.StructField("No_Of_records_processed", T.LongType()),
        T.StructField("Start_Time", T.StringType()),
        T.StructField("EndTime", T.StringType()),
    ]
)

FILE_MANIFEST = T.StructType(
    [
        T.StructField("FileName", T.StringType()),
        T.StructField("Status", T.StringType()),
        T.StructField("Error_description", T.StringType()),
        T.StructField("Total_row_Count", T.LongType()),
        T.StructField("StartTime", T.StringType()),
        T.StructField("EndTime", T.StringType()),
    ]
)


def error_records(
    df: DataFrame, dataset: str | Column, description: str | Column, columns: Sequence[str] | None = None
) -> DataFrame:
    """Four-column error records, one per row of ``df``."""
    dataset = F.lit(dataset) if isinstance(dataset, str) else dataset
    description = F.lit(description) if isinstance(description, str) else description
    return df.select(
        dataset.alias("Data_Set_Name"),
        description.alias("Error_Description"),
        row_text(cols(columns or df.columns)).alias("Error_Record"),
        F.current_timestamp().alias("Insert_Time"),
    )


def run_manifest(
    spark: SparkSession,
    dataset: str,
    status: str,
    received: int | None,
    processed: int | None,
    started: str,
    ended: str,
) -> DataFrame:
    """One row; rejected is what was received and not processed."""
    rejected = None if received is None or processed is None else received - processed
    row = (dataset, status, received, rejected, processed, started, ended)
    return spark.createDataFrame([row], RUN_MANIFEST)


def row_counts(df: DataFrame, bad: Column) -> DataFrame:
    """Received, processed and rejected rows in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(~bad).alias("processed"),
    ).withColumn("rejected", F.col("received") - F.col("processed"))
