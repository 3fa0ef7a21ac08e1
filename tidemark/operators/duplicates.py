"""Removing duplicate rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..naming import ref, require_columns

_RANK = "__rank"


def drop_duplicates(
    df: DataFrame,
    keys: list[str] | None = None,
    order_by: list[str | Column] | None = None,
) -> DataFrame:
    """Keep one row per key; without keys, one of each group of equal rows.

    ``order_by`` says which row of a key is the first; end it with enough columns
    to break ties. Without it any row may be kept, since a table has no order.
    Nulls are equal to each other.

    Both ways reduce each key to one row in every map task before the shuffle
    (``WindowGroupLimit`` under the row number, partial aggregation otherwise), so
    a key that holds a large part of the rows costs no more than any other.
    """
    if not keys:
        return df.dropDuplicates()
    require_columns(df, keys)
    if not order_by:
        return df.dropDuplicates(keys)
    order = [ref(c) if isinstance(c, str) else c for c in order_by]
    window = Window.partitionBy(*[ref(k) for k in keys]).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(ref(_RANK) == 1).drop(_RANK)
