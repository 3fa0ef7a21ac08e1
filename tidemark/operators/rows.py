"""Unions, row numbers and row slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..naming import ref
from ..session import fresh_path
from .slices import Order, keys_at, keys_of

_PART, _POSITION, _START = "__part", "__position", "__start"


def union_rows(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of tables with the same column names and types, in the same order."""
    expected = first.dtypes
    for other in others:
        if other.dtypes != expected:
            raise ValueError(f"schemas differ: {expected} and {other.dtypes}")
        first = first.unionAll(other)
    return first


def first_rows(df: DataFrame, rows: int = 5) -> DataFrame:
    """Any ``rows`` rows, for looking at a table."""
    return df.limit(rows)


def number_rows(
    df: DataFrame, order_by: list[str | Column], name: str = "row_number", path: str | None = None
) -> DataFrame:
    """Add the 0-based position of each row in a total order, without one big task.

    The range-sorted table is written once, with the position inside each sorted
    partition; the start of a partition is the sum of the rows before it, a table
    with one row per partition that is broadcast. ``order_by`` must be a total order
    (unique), which also keeps the ranges even. Written to ``path``, or to a fresh
    place in the shared folder.
    """
    spark = df.sparkSession
    path = path or fresh_path(spark, "numbered")
    order = [ref(c) if isinstance(c, str) else c for c in order_by]
    in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    (
        df.orderBy(*order)
        .withColumns({_PART: F.spark_partition_id(), _POSITION: in_partition})
        .write.parquet(path)
    )
    written = spark.read.parquet(path)
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        written.groupBy(_PART)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(_PART, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(_START))
    )
    numbered = written.join(F.broadcast(starts), _PART)
    return numbered.select([ref(c) for c in df.columns] + [(ref(_START) + ref(_POSITION)).alias(name)])


def slice_rows(
    df: DataFrame, order_by: list[str | Column], offset: int, length: int, path: str | None = None
) -> DataFrame:
    """Rows ``offset`` to ``offset + length`` of a total order, in that order.

    The keys at both places are selected first (see ``slices.keys_at``), in some scans of the key columns
    that run when this is called; the slice is a filter between them, so nothing is written and no task
    holds the rows before it. ``order_by`` names columns, or gives them as Columns with their
    directions; it must be a total order (unique), and the table the same in every scan.

    Other expressions to order by, and a ``path``, take the slice out of ``number_rows``, which writes the
    whole table there, or to a fresh place in the shared folder.
    """
    if offset < 0 or length < 0:
        raise ValueError("offset and length must not be negative")
    keys = None if path else keys_of(df, order_by)
    if keys is None:
        numbered = number_rows(df, order_by, name="__row", path=path)
        inside = (ref("__row") >= offset) & (ref("__row") < offset + length)
        return numbered.filter(inside).select([ref(c) for c in df.columns])
    rows = df.count()
    if offset >= rows or not length:
        return df.where(F.lit(False))
    order = Order(df, keys)
    places = [p for p in (offset, offset + length) if 0 < p < rows]
    found = dict(zip(places, keys_at(order, places, rows)))
    return df.where(order.between(found.get(offset), found.get(offset + length))).orderBy(*order.columns)
