"""Ratios with a defined result for a zero denominator, and decimal rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(c: Column, digits: int = 2) -> Column:
    """Round a double half to even on the scaled value."""
    scale = float(10**digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def rate(part: Column, whole: Column, when_empty: float | None = None) -> Column:
    """``part / whole``; ``when_empty`` (null by default) where ``whole`` is not positive."""
    empty = F.lit(when_empty).cast("double")
    return F.when(whole > 0, part.cast("double") / whole).otherwise(empty)


def two_decimals(c: Column) -> Column:
    """A double from 0 up to a million as text with two decimals, as C's ``%.2f`` writes it.

    The exact binary value is rounded, half to even; Java's formatter rounds the shortest
    decimal that reads back as the value. So the value is taken apart into whole numbers:
    it is ``parts / 2**90``, hundredths are what ``100 * parts`` holds of ``2**90``.
    """
    unit, half = F.lit(f"{1 << 90}").cast("decimal(28,0)"), F.lit(f"{1 << 89}").cast("decimal(28,0)")

    def hundredfold(x: Column) -> Column:
        whole = F.floor(x * float(1 << 40)).cast("decimal(20,0)")
        rest = F.floor((x * float(1 << 40) - whole.cast("double")) * float(1 << 50)).cast("decimal(16,0)")
        parts = (whole * F.lit(f"{1 << 50}").cast("decimal(16,0)") + rest) * F.lit(100).cast("decimal(3,0)")
        return parts.cast("decimal(38,0)")

    def rounded(parts: Column) -> Column:
        left = parts % unit
        # A whole quotient; the half keeps the division's rounding out of it.
        below = F.floor((parts - left) / unit + F.lit("0.5").cast("decimal(2,1)")).cast("long")
        return below + ((left > half) | ((left == half) & (below % 2 == 1))).cast("long")

    def written(hundredths: Column) -> Column:
        return F.concat(
            F.floor(hundredths / 100).cast("long").cast("string"), F.lit("."), F.lpad((hundredths % 100).cast("string"), 2, "0")
        )

    # Each step names the one before by a lambda's argument, so that it is not written out again.
    steps = F.array(c)
    for step in (hundredfold, rounded, written):
        steps = F.transform(steps, step)
    return steps[0]
