"""Date enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import weekday_name
from ..naming import ref, require_columns


def add_date_parts(df: DataFrame, column: str = "date") -> DataFrame:
    """Add the integer columns ``day``, ``month`` and ``year``."""
    require_columns(df, [column])
    date = ref(column)
    return df.withColumns({"day": F.dayofmonth(date), "month": F.month(date), "year": F.year(date)})


def add_weekday_name(
    df: DataFrame, column: str = "date", name: str = "weekday", compat_shift: bool = False
) -> DataFrame:
    """Add the Spanish weekday name (``compat_shift``: see ``weekday_name``)."""
    require_columns(df, [column])
    return df.withColumn(name, weekday_name(ref(column), compat_shift))
