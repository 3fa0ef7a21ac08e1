"""Row literals and landed JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..naming import ref, require_columns


def as_table(spark: SparkSession, data: object, schema: T.StructType | str | None = None) -> DataFrame:
    """A DataFrame as it is, or a few literal rows (a dict, or a list of dicts) as one."""
    if isinstance(data, DataFrame):
        return data
    if isinstance(data, dict):
        data = [data]
    if isinstance(data, list) and data and all(isinstance(r, dict) for r in data):
        return spark.createDataFrame(data, schema)
    raise TypeError(f"expected a DataFrame, a dict or a list of dicts, got {type(data).__name__}")


def read_json_records(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType | str,
    columns: list[str] | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Flat JSON objects landed as files, each line an object or an array of objects.

    ``multiline`` reads files that hold one array over many lines, each file in one
    task; land large responses as one array per line or per file instead.
    """
    df = spark.read.schema(schema).json(paths, multiLine=multiline, mode="FAILFAST")
    return df.select([ref(c) for c in require_columns(df, columns)]) if columns else df
