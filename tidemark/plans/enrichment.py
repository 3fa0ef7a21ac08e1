"""Clean tables to enriched and aggregated ones."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..fixed_values import CLIENT_FILLERS
from ..operators import (
    add_date_parts,
    add_weekday_name,
    cast_columns,
    fill_nulls,
    flag_membership,
    flag_rates,
    merge,
)

# --- Fixed values: dates that are compared with the holidays; types of the clients ---
MESSAGE_DATES = ["date", "sent_at", "opened_first_time_at", "opened_last_time_at"]
CAMPAIGN_DATES = ["started_at", "finished_at"]
CLIENT_TYPES = {
    "age": "int",
    "gender": "category",
    "preferred_channel": "category",
    "loyalty_level": "category",
    "average_purchase_value": "float",
    "churn_risk": "float",
}


def enriched_messages(messages: DataFrame, holidays: DataFrame) -> DataFrame:
    return flag_membership(messages, MESSAGE_DATES, holidays, "date")


def enriched_campaigns(campaigns: DataFrame, holidays: DataFrame) -> DataFrame:
    return flag_membership(campaigns, CAMPAIGN_DATES, holidays, "date")


def enriched_clients(clients: DataFrame, records: DataFrame) -> DataFrame:
    """All clients with what the customer records say about them, gaps filled.

    The record id identifies a customer, so only the client side can be skewed.
    """
    joined = merge(clients, records, left_on="client_id", right_on="id", how="left", unique="right")
    return joined.transform(fill_nulls, CLIENT_FILLERS).transform(cast_columns, CLIENT_TYPES)


def enriched_holidays(holidays: DataFrame, compat_shift: bool = False) -> DataFrame:
    return holidays.transform(add_date_parts).transform(add_weekday_name, compat_shift=compat_shift)


def campaign_performance(messages: DataFrame) -> DataFrame:
    return flag_rates(messages)
