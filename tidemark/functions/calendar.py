"""Names of weekdays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import WEEKDAY_NAMES


def weekday_name(c: Column, compat_shift: bool = False) -> Column:
    """Spanish weekday name of a date or timestamp.

    ``compat_shift`` gives the name of the following day, and null for Sunday.
    """
    monday_based = F.weekday(c)
    position = monday_based + (2 if compat_shift else 1)
    return F.try_element_at(F.array(*[F.lit(n) for n in WEEKDAY_NAMES]), position)
