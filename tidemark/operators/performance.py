"""Event totals and rates per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rate, round_half_even
from ..naming import ref, require_columns

# --- Fixed values: flag columns read by default, by the total they feed ---
MESSAGE_FLAGS = {
    "opened": ["is_opened"],
    "clicked": ["is_clicked"],
    "purchased": ["is_purchased"],
    "unsubscribed": ["is_unsubscribed"],
    "bounced": ["is_hard_bounced", "is_soft_bounced"],
}
TOTALS = ["total_sent", *[f"total_{name}" for name in MESSAGE_FLAGS]]


def _checked(flags: dict[str, list[str]] | None) -> dict[str, list[str]]:
    flags = {**MESSAGE_FLAGS, **(flags or {})}
    unknown = set(flags) - set(MESSAGE_FLAGS)
    if unknown:
        raise ValueError(f"unknown totals {sorted(unknown)}")
    return flags


def flag_totals(
    df: DataFrame, key: str = "campaign_id", id_column: str = "message_id", flags: dict[str, list[str]] | None = None
) -> DataFrame:
    """Totals of sent, opened, clicked, purchased, unsubscribed and bounced rows per key.

    ``flags`` maps each total to the flag columns (boolean or 0/1) of which one
    must be set. Null flags count as not set; a null key is a key of its own. Totals of parts
    of a table add up to those of the whole (``fold_totals``).
    """
    flags = _checked(flags)
    require_columns(df, [key, id_column, *[c for columns in flags.values() for c in columns]])

    def is_set(columns: list[str]) -> Column:
        hit = ref(columns[0]).cast("boolean")
        for c in columns[1:]:
            hit = hit | ref(c).cast("boolean")
        return hit

    return df.groupBy(ref(key)).agg(
        F.count(ref(id_column)).alias("total_sent"),
        *[F.count_if(is_set(columns)).alias(f"total_{name}") for name, columns in flags.items()],
    )


def fold_totals(totals: DataFrame, key: str = "campaign_id") -> DataFrame:
    """Totals per key of parts of a table, as of ``flag_totals``, added up to one row per key."""
    require_columns(totals, [key, *TOTALS])
    return totals.groupBy(ref(key)).agg(*[F.sum(n).alias(n) for n in TOTALS])


def total_rates(totals: DataFrame, digits: int = 2) -> DataFrame:
    """Totals per key with the five rounded rates.

    A rate of sent rows is null where none was sent; click and conversion rates are 0
    where nothing was opened or clicked.
    """
    sent, opened, clicked = ref("total_sent"), ref("total_opened"), ref("total_clicked")
    rates = {
        "open_rate": rate(opened, sent),
        "click_rate": rate(clicked, opened, when_empty=0.0),
        "conversion_rate": rate(ref("total_purchased"), clicked, when_empty=0.0),
        "unsubscribe_rate": rate(ref("total_unsubscribed"), sent),
        "bounce_rate": rate(ref("total_bounced"), sent),
    }
    return totals.withColumns({name: round_half_even(c, digits) for name, c in rates.items()})


def flag_rates(
    df: DataFrame,
    key: str = "campaign_id",
    id_column: str = "message_id",
    flags: dict[str, list[str]] | None = None,
    digits: int = 2,
) -> DataFrame:
    """``flag_totals`` per key, and the five rates of ``total_rates``.

    All totals are counters, combined in the map tasks: the shuffle carries one
    row per key and map task, however the rows spread over the keys.
    """
    return total_rates(flag_totals(df, key, id_column, flags), digits)
