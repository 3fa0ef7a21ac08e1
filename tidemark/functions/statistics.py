"""Statistical aggregates that are null where Spark's own would fail."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pearson(a: Column, b: Column) -> Column:
    """Pearson correlation over the rows where both are known; null if one is constant.

    ``corr`` divides by zero on a constant column, which fails a job in ANSI mode.
    """
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
