"""Nulls. NaN is a value here, unlike in Spark's ``na`` functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..naming import ref, require_columns, type_of


def drop_nulls(
    df: DataFrame,
    columns: list[str] | None = None,
    any_column: bool = False,
    fill: dict[str, object] | None = None,
) -> DataFrame:
    """Drop rows with a null in ``columns`` (or in any column), then fill nulls."""
    checked = list(df.columns) if any_column else require_columns(df, columns or [])
    if checked:
        df = df.filter(reduce(lambda a, b: a & b, [ref(c).isNotNull() for c in checked]))
    return fill_nulls(df, fill) if fill else df


def _accepts(kind: T.DataType, value: object) -> bool:
    """Whether a Python literal is a value of the column type without loss."""
    if isinstance(value, bool):
        return isinstance(kind, T.BooleanType)
    if isinstance(value, int):
        return isinstance(kind, T.NumericType)
    if isinstance(value, float):
        return isinstance(kind, T.FractionalType)
    if isinstance(value, str):
        return isinstance(kind, T.StringType)
    return isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType))


def fill_nulls(df: DataFrame, fill: dict[str, object]) -> DataFrame:
    """Replace nulls by one literal per column, which must fit the column's type."""
    require_columns(df, fill)
    for name, value in fill.items():
        if not _accepts(type_of(df, name), value):
            raise ValueError(f"{value!r} does not fit column {name!r} of type {type_of(df, name).simpleString()}")
    return df.withColumns(
        {n: F.coalesce(ref(n), F.lit(v).cast(type_of(df, n))) for n, v in fill.items()}
    )
