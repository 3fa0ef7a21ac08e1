"""CSV and Parquet writers. A path is a folder of part files, one per task."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..naming import ref, require_columns
from ..sources.records import as_table

# Spark's own formats stop at milliseconds.
_CSV_TIMES = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}

_MODES = {"w": "overwrite", "a": "append", "overwrite": "overwrite", "append": "append"}


def _mode(mode: str) -> str:
    if mode not in _MODES:
        raise ValueError(f"mode={mode!r} is not one of {sorted(_MODES)}")
    return _MODES[mode]


def write_csv(
    df: DataFrame, path: str, sep: str = ",", header: bool = True, mode: str = "overwrite"
) -> str:
    """Write CSV; null is an empty cell, empty text a quoted one. Returns the path.

    Do not overwrite a path that the plan of ``df`` reads.
    """
    if not path:
        raise ValueError("no path was given")
    options = {"sep": sep, "header": str(header).lower(), "quote": '"', "escape": '"', **_CSV_TIMES}
    df.write.mode(_mode(mode)).options(nullValue="", emptyValue='""', **options).csv(path)
    return path


def _existing_types(spark: SparkSession, path: str) -> list[tuple[str, str]] | None:
    try:
        return spark.read.parquet(path).dtypes
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    compression: str = "snappy",
    partition_by: list[str] | None = None,
    rebalance: bool = True,
) -> str:
    """Write Parquet; appending adds files and requires the same columns and types.

    With ``partition_by`` the rows are first rebalanced by those columns: few files per
    partition instead of one per task and partition, and a large partition is still
    written by several tasks. Turn that off for rows that come in this order already.
    Do not overwrite a path that the plan of ``df`` reads. Returns the path.
    """
    if not path:
        raise ValueError("no path was given")
    if _mode(mode) == "append":
        existing = _existing_types(df.sparkSession, path)
        own = df.dtypes
        if partition_by:
            # Partition columns are read back after the others.
            own = [c for c in own if c[0] not in partition_by] + [(c, dict(own)[c]) for c in partition_by]
        if existing is not None and existing != own:
            raise ValueError(f"cannot append {own} to {existing}")
    if partition_by and rebalance:
        df = df.hint("rebalance", *[ref(c) for c in require_columns(df, partition_by)])
    writer = df.write.mode(_mode(mode)).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_batches(
    spark: SparkSession,
    batches: Iterable[object],
    path: str,
    write: Callable[..., str] = write_parquet,
    mode: str = "overwrite",
    **options,
) -> str:
    """Write a few batches (tables or literal rows) one after the other.

    The first one follows ``mode``, the others are appended. For an unbounded or
    repeated feed use ``streaming.ingest_files``.
    """
    count = 0
    for count, batch in enumerate(batches, start=1):
        write(as_table(spark, batch), path, mode=mode if count == 1 else "append", **options)
    if not count:
        raise ValueError("there was no batch to write")
    return path
