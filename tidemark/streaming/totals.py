"""Totals per key that are kept up to date: each arrival is counted once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.performance import TOTALS, flag_totals, fold_totals, total_rates
from ..naming import ref
from ..sinks.batches import batch_path, write_batch
from ..sinks.files import write_parquet


def add_totals(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    key: str = "campaign_id",
    id_column: str = "message_id",
    flags: dict[str, list[str]] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    files_per_batch: int = 1000,
) -> None:
    """Count the rows of the Parquet files of ``folder`` that arrived since the last run.

    A batch of files becomes one table of partial totals, a row per key, written under the batch's
    number: run again after a failure it replaces what it left. The checkpoint knows the files
    that were counted, which are not read again. ``transform`` works row by row, or against tables that
    stay as they are (a filter on known keys counts a row as of the run that reads it).
    """

    def write(rows: DataFrame, number: int) -> None:
        rows = transform(rows) if transform else rows
        write_batch(flag_totals(rows, key, id_column, flags), target, number)

    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    rows = reader.option("maxFileAge", "36500d").option("pathGlobFilter", "*.parquet").parquet(folder)
    query = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()


def _parts(spark: SparkSession, target: str) -> dict[str, list[int]]:
    """Numbers of the ``batch`` and ``folded`` tables of totals, in order; lists names only."""
    found: dict[str, set[int]] = {"batch": set(), "folded": set()}
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    for row in listed.load(target).select(F.element_at(F.split("path", "/"), -2).alias("name")).distinct().collect():
        kind, _, number = row["name"].rpartition("-")
        if kind in found:
            found[kind].add(int(number))
    return {kind: sorted(numbers) for kind, numbers in found.items()}


def _folded_path(target: str, number: int) -> str:
    return batch_path(target, number).replace("/batch-", "/folded-")


def read_totals(spark: SparkSession, target: str, key: str = "campaign_id", digits: int = 2) -> DataFrame:
    """Totals and rates per key of all rows counted so far, as ``flag_rates`` of the whole table gives them."""
    parts = _parts(spark, target)
    last = parts["folded"][-1:]
    paths = [_folded_path(target, n) for n in last]
    paths += [batch_path(target, n) for n in parts["batch"] if not last or n > last[0]]
    return total_rates(fold_totals(spark.read.parquet(*paths), key), digits)


def compact_totals(spark: SparkSession, target: str, key: str = "campaign_id") -> None:
    """Fold all partial totals so far to one table, that later reads start from.

    Nothing is taken away: a run that fails leaves the parts it read, and is simply run again.
    Not to be run beside ``add_totals``.
    """
    parts = _parts(spark, target)
    if parts["batch"] and parts["batch"][-1:] != parts["folded"][-1:]:
        totals = read_totals(spark, target, key).select(ref(key), *TOTALS)
        write_parquet(totals, _folded_path(target, parts["batch"][-1]))
