"""Numbered batches: writing one again replaces it."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import count

from pyspark.sql import DataFrame, SparkSession

from ..sources.records import as_table
from .files import write_csv, write_parquet

_WRITERS: dict[str, Callable[..., str]] = {"parquet": write_parquet, "csv": write_csv}


def batch_path(path: str, number: int) -> str:
    """Where a batch lies; names sort as numbers do."""
    if number < 0:
        raise ValueError("batches are numbered from 0")
    return f"{path.rstrip('/')}/batch-{number:012d}"


def write_batch(df: DataFrame, path: str, number: int, fmt: str = "parquet", **options) -> str:
    """Write batch ``number`` of the table at ``path``, in place of what an earlier attempt left there.

    The number decides where a batch lies, so a stream's ``foreachBatch`` can run this again
    after a failure and add nothing twice. Read the table with ``nested=True``. Returns the
    batch's path.
    """
    if fmt not in _WRITERS:
        raise ValueError(f"fmt={fmt!r} is not one of {sorted(_WRITERS)}")
    return _WRITERS[fmt](df, batch_path(path, number), mode="overwrite", **options)


def write_feed(
    spark: SparkSession, batches: Iterable[object], path: str, first: int = 0, fmt: str = "parquet", **options
) -> int:
    """Write a feed of tables or literal rows as batches from number ``first`` on, one at a time.

    Returns the number that the feed goes on with. A feed that is taken up again from an earlier
    number replaces the batches it repeats; an empty one writes nothing.
    """
    numbers = count(first)
    for batch in batches:
        write_batch(as_table(spark, batch), path, next(numbers), fmt, **options)
    return next(numbers)
