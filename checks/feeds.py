"""The test tables in the form in which feeds arrive: text columns, text dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DASHED = ("yyyy-M-d",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def month_ending(name: str, form: str = "yyyy-MM-dd") -> Column:
    """Last day of the month, the date that periodic feeds carry."""
    return F.date_format(F.last_day(F.col(name)), form)


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def day_text(name: str, form: str = "yyyy-MM-dd") -> Column:
    return F.date_format(F.col(name), form)


def orders(spark: SparkSession, sf_dir: str, form: str = "yyyy-MM-dd") -> DataFrame:
    df = table(spark, sf_dir, "orders").withColumn("o_orderdate", day_text("o_orderdate", form))
    return as_text(df)


def lineitem(spark: SparkSession, sf_dir: str, form: str = "yyyy-MM-dd") -> DataFrame:
    df = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", day_text("l_shipdate", form))
    return as_text(df)


def monthly_lines(spark: SparkSession, sf_dir: str, form: str = "yyyy-MM-dd") -> DataFrame:
    df = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", month_ending("l_shipdate", form))
    return as_text(df)


def monthly_orders(spark: SparkSession, sf_dir: str, form: str = "yyyy-MM-dd") -> DataFrame:
    df = table(spark, sf_dir, "orders").withColumn("o_orderdate", month_ending("o_orderdate", form))
    return as_text(df)


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(table(spark, sf_dir, "customer"))
