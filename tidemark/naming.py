"""Column references by exact name and plan-time checks on column names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ref(name: str) -> Column:
    """Reference a column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def require_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Return ``names`` as a list; raise if the table lacks one of them.

    Spark's own ``drop`` and rename silently ignore unknown names.
    """
    names = list(names)
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"unknown columns {missing}; the table has {df.columns}")
    return names


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType
