"""Flagging dates by membership in a list of days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..naming import ref, require_columns
from ..session import BROADCAST_ROWS, has_at_most

_DAY = "__day"


def flag_membership(
    df: DataFrame,
    columns: list[str],
    days: DataFrame,
    day_column: str,
    suffix: str = "_holiday",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add ``<column><suffix>`` per listed column: is its date one of ``days``?

    Both sides are compared as dates. The flag is null where the value is null;
    nulls in the list match nothing.

    The distinct days are counted first (a small aggregation over the list). Up to
    ``broadcast_rows`` they are broadcast, once for all columns, and the flagged
    table is not shuffled. Beyond that the joins are left to Spark; the days are
    unique, so only the flagged table can be skewed, and adaptive execution splits
    that side of a left join. For this the days are rebalanced, so that the join has
    to shuffle them itself.
    """
    require_columns(df, columns)
    require_columns(days, [day_column])
    unique_days = (
        days.select(ref(day_column).cast("date").alias(_DAY)).filter(ref(_DAY).isNotNull()).distinct()
    )
    small = has_at_most(unique_days, broadcast_rows)
    unique_days = F.broadcast(unique_days) if small else unique_days.hint("rebalance")
    inputs = df.columns
    flags = []
    for i, name in enumerate(columns):
        side = unique_days.select(ref(_DAY).alias(f"__day{i}"), F.lit(True).alias(f"__hit{i}"))
        df = df.join(side, ref(name).cast("date") == ref(f"__day{i}"), "left")
        hit = F.when(ref(name).isNotNull(), F.coalesce(ref(f"__hit{i}"), F.lit(False)))
        flags.append(hit.alias(f"{name}{suffix}"))
    return df.select([ref(c) for c in inputs] + flags)
