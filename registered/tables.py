"""Shared helpers of the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SQL_TIMESTAMP_TEXT = "%Y-%m-%d %H:%M:%S.%f"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(name: str) -> Column:
    """A timestamp column as text, under its name."""
    return F.date_format(name, TIMESTAMP_TEXT).alias(name)


def sql_text(name: str, alias: str | None = None) -> str:
    return f"strftime({name}, '{SQL_TIMESTAMP_TEXT}') AS {alias or name}"


def longs(df: DataFrame, *names: str) -> DataFrame:
    """The table with some integer columns as BIGINT, as SQL counters are."""
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})
