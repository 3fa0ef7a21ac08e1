"""Filtering, naming, dropping and converting columns."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import parse_boolean, parse_timestamp, to_double, to_long, to_text
from ..naming import ref, require_columns, type_of


def where(df: DataFrame, condition: str | Column) -> DataFrame:
    """Keep the rows for which a boolean SQL text or column is true."""
    if isinstance(condition, str):
        if not condition.strip():
            raise ValueError("the condition is empty")
        condition = F.expr(condition)
    elif not isinstance(condition, Column):
        raise TypeError(f"expected SQL text or a Column, got {type(condition).__name__}")
    kind = df.select(condition.alias("c")).schema["c"].dataType
    if not isinstance(kind, T.BooleanType):
        raise ValueError(f"the condition is of type {kind.simpleString()}, not boolean")
    return df.filter(condition)


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename all columns of the map at once, so that two names can be swapped."""
    if not names:
        raise ValueError("the rename map is empty")
    require_columns(df, names)
    result = [names.get(c, c) for c in df.columns]
    if len(set(result)) < len(result):
        raise ValueError(f"renaming gives duplicate column names: {result}")
    return df.select([ref(c).alias(n) for c, n in zip(df.columns, result)])


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Remove columns; an empty list leaves the table as it is."""
    if not columns:
        warnings.warn("no columns to drop were given", stacklevel=2)
        return df
    dropped = set(require_columns(df, columns))
    return df.select([ref(c) for c in df.columns if c not in dropped])


def keep_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep the listed columns in the listed order."""
    return df.select([ref(c) for c in require_columns(df, columns)])


def add_columns(df: DataFrame, columns: dict[str, str | Column]) -> DataFrame:
    """Add or replace columns by SQL text or Column, all seeing the input row."""
    return df.withColumns({n: F.expr(c) if isinstance(c, str) else c for n, c in columns.items()})


def _as_timestamp(df: DataFrame, name: str) -> Column:
    if isinstance(type_of(df, name), (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return ref(name)
    if not isinstance(type_of(df, name), (T.StringType, T.CharType, T.VarcharType)):
        warnings.warn(f"column {name!r} is not text, it is left as it is", stacklevel=3)
        return ref(name)
    return parse_timestamp(ref(name))


_CASTS = {
    "int": lambda df, c: to_long(ref(c)),
    "float": lambda df, c: to_double(ref(c)),
    "str": lambda df, c: to_text(ref(c)),
    "category": lambda df, c: to_text(ref(c)),
    "bool": lambda df, c: parse_boolean(ref(c)),
    "timestamp": _as_timestamp,
}


def cast_columns(df: DataFrame, types: dict[str, str], count_lost: str | None = None) -> DataFrame:
    """Convert columns; values that do not convert become null.

    Types: ``int, float, str, category, bool, timestamp``. Unknown columns and
    unknown types are skipped with a warning. ``count_lost`` names an observation
    (see ``DataFrame.observe``) that counts per column the values that became null,
    in the same pass as the action that runs the plan.
    """
    converted: dict[str, Column] = {}
    for name, kind in types.items():
        if name not in df.columns:
            warnings.warn(f"column {name!r} not found, skipped", stacklevel=2)
        elif kind not in _CASTS:
            warnings.warn(f"type {kind!r} of column {name!r} is not supported, skipped", stacklevel=2)
        else:
            converted[name] = _CASTS[kind](df, name)
    if not converted:
        return df
    if count_lost:
        lost = [F.count_if(ref(n).isNotNull() & c.isNull()).alias(n) for n, c in converted.items()]
        df = df.observe(count_lost, *lost)
    return df.withColumns(converted)


def columns_of_kind(df: DataFrame, kind: str) -> list[str]:
    """Names of the ``numeric``, ``text`` or ``date`` columns.

    A text column counts as ``date`` by its name: ``date`` or ending in ``at``.
    """
    temporal = (T.DateType, T.TimestampType, T.TimestampNTZType)

    def kind_of(field: T.StructField) -> str | None:
        if isinstance(field.dataType, T.NumericType):
            return "numeric"
        if isinstance(field.dataType, temporal):
            return "date"
        if isinstance(field.dataType, T.StringType):
            return "date" if field.name == "date" or field.name.endswith("at") else "text"
        return None

    if kind not in ("numeric", "text", "date"):
        raise ValueError(f"unknown kind {kind!r}")
    return [f.name for f in df.schema.fields if kind_of(f) == kind]
