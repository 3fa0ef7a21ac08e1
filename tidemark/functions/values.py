"""Tolerant conversions: a value that cannot be converted becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import FALSE_WORDS, TRUE_WORDS

# What a plain cast reads, less its partial dates and its zones, which it would drop.
_TIME = r"([ T]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)?"
_ISO_TEXT = rf"^\d{{4}}-\d{{2}}-\d{{2}}{_TIME}$"
# The year or the day first, three separators, blanks around; anything else as a whole.
_ANY_TEXT = (
    r"(?s)^\s*(?:(\d{4})[-/.](\d{2})[-/.](\d{2})|(\d{2})[-/.](\d{2})[-/.](\d{4}))" + _TIME + r"\s*$|^.*$"
)
# Groups that took no part are empty, so that other text becomes "--", which is no date.
_AS_ISO = "$1$6-$2$5-$3$4$7"


def to_long(c: Column) -> Column:
    return c.try_cast("bigint")


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def to_text(c: Column) -> Column:
    return c.cast("string")


def parse_boolean(c: Column) -> Column:
    """True or false by word list, null for any other text."""
    word = F.lower(c.cast("string"))
    return F.when(word.isin(TRUE_WORDS + FALSE_WORDS), word.isin(TRUE_WORDS))


def parse_timestamp(c: Column, formats: list[str] | None = None) -> Column:
    """Text to a timestamp without time zone; null where the text is not one.

    Without ``formats``: year-first or day-first dates with ``-``, ``/`` or ``.``
    and an optional time with up to nine fractional digits (kept to microseconds).
    With ``formats``: the first of these Java date patterns that reads the text.
    """
    if formats:
        parsed = [F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats]
        return F.coalesce(*parsed)
    # ISO text, the common case, costs one match and the cast. A single cast keeps the
    # generated code of a table with many such columns small enough to be compiled.
    iso = F.when(c.rlike(_ISO_TEXT), c).otherwise(F.regexp_replace(c, F.lit(_ANY_TEXT), F.lit(_AS_ISO)))
    return iso.try_cast("timestamp_ntz")
