"""Incremental file ingest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from ..sinks.batches import write_batch
from ..sources.csv_records import layout, lines_of, records
from ..sources.files import parsed

# The stream ignores files this much older than the newest one it has seen, and forgets
# their names: longer than any file's age, so that late files are read.
_NO_AGE_LIMIT = "36500d"


def ingest_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    fmt: str = "csv",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    files_per_batch: int = 1000,
    sep: str = ",",
    pattern: str | None = None,
    partition_by: list[str] | None = None,
    multiline: bool = False,
) -> None:
    """Add the files of ``folder`` that arrived since the last run to a Parquet table.

    The checkpoint remembers which files were read and the target's own log which
    batches were committed, so a rerun after a failure neither loses nor repeats
    rows. A file counts as new by its name, however old it is; for that the checkpoint
    keeps the name of every file ever read, and its log grows with them. Both must be
    on storage that outlives the run. CSV columns are taken by position, as in ``schema``; the
    header is checked. ``transform`` must work row by row (cast, fill, filter, drop).

    A line break in a CSV cell fails the run, unless ``multiline`` is set: then the quotes of a
    batch's files are counted first (see ``read_csv``), and the target is a folder of numbered
    batches (see ``ingest_batches``), read with ``read_parquet(nested=True)``.
    """
    if multiline and fmt == "csv" and not partition_by:
        return ingest_batches(spark, folder, schema, target, checkpoint, "parquet", transform, files_per_batch, sep, pattern)
    if multiline:
        raise ValueError("several lines to a record need CSV files and no partitions")
    reader = _arrivals(spark, files_per_batch, pattern or f"*.{fmt}")
    if fmt == "csv":
        rows = _cells(records(lines_of(reader, folder), None, schema.names, sep), schema, sep)
    else:
        rows = reader.schema(schema).format(fmt).load(folder)
    if transform:
        rows = transform(rows)
    writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.trigger(availableNow=True).start(target).awaitTermination()


def ingest_batches(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    target_format: str = "parquet",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    files_per_batch: int = 1000,
    sep: str = ",",
    pattern: str | None = None,
) -> None:
    """Add the CSV files of ``folder`` that arrived since the last run to a folder of batches, as Parquet or CSV.

    Cells may hold line breaks. A batch is written under its number, so that one that is run
    again after a failure takes the place of what it left the first time; read the target with
    ``nested=True``. Otherwise as ``ingest_files``.
    """

    def write(lines: DataFrame, number: int) -> None:
        rows = _cells(records(lines, layout(lines, header=True), schema.names, sep), schema, sep)
        write_batch(transform(rows) if transform else rows, target, number, target_format)

    lines = lines_of(_arrivals(spark, files_per_batch, pattern or "*.csv"), folder)
    query = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()


def _arrivals(spark: SparkSession, files_per_batch: int, pattern: str) -> DataStreamReader:
    options = {"maxFilesPerTrigger": files_per_batch, "maxFileAge": _NO_AGE_LIMIT, "pathGlobFilter": pattern}
    return spark.readStream.options(**options)


def _cells(rows: DataFrame, schema: T.StructType, sep: str) -> DataFrame:
    return parsed(rows, schema, sep, "FAILFAST", []).select("__cells.*")
