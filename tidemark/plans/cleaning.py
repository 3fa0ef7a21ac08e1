"""Raw tables to clean ones; each step works row by row except the holidays'."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..fixed_values import CAMPAIGN_FILLERS, MESSAGE_FILLERS
from ..operators import cast_columns, drop_columns, drop_duplicates, drop_nulls, fill_nulls, keep_columns, keep_referenced

# --- Fixed values: columns that are almost always null or say nothing ---
EMPTY_CAMPAIGN_COLUMNS = ["position", "is_test", "hour_limit", "ab_test"]
EMPTY_MESSAGE_COLUMNS = [
    "category",
    "created_at",
    "updated_at",
    "clicked_first_time_at",
    "clicked_last_time_at",
    "unsubscribed_at",
    "hard_bounced_at",
    "soft_bounced_at",
    "complained_at",
    "blocked_at",
    "purchased_at",
]

# --- Fixed values: column types of the clean tables ---
RECORD_TYPES = {
    "id": "int",
    "age": "int",
    "country": "category",
    "preferred_channel": "category",
    "loyalty_level": "category",
    "average_purchase_value": "float",
    "churn_risk": "float",
}
CAMPAIGN_TYPES = {
    "id": "int",
    "total_count": "int",
    "subject_length": "int",
    "campaign_type": "category",
    "channel": "category",
    "started_at": "timestamp",
    "finished_at": "timestamp",
    "subject_with_personalization": "bool",
    "subject_with_deadline": "bool",
    "subject_with_emoji": "bool",
    "subject_with_bonuses": "bool",
    "subject_with_discount": "bool",
    "subject_with_saleout": "bool",
    "warmup_mode": "bool",
}
MESSAGE_TYPES = {
    "id": "int",
    "campaign_id": "int",
    "client_id": "int",
    "date": "timestamp",
    "sent_at": "timestamp",
    "opened_first_time_at": "timestamp",
    "opened_last_time_at": "timestamp",
    "is_opened": "bool",
    "is_clicked": "bool",
    "is_unsubscribed": "bool",
    "is_hard_bounced": "bool",
    "is_soft_bounced": "bool",
    "is_complained": "bool",
    "is_blocked": "bool",
    "is_purchased": "bool",
}


def clean_customer_records(records: DataFrame) -> DataFrame:
    return cast_columns(records, RECORD_TYPES)


def clean_campaigns(raw: DataFrame) -> DataFrame:
    """Campaigns with a start; counts and labels filled; flags and dates typed."""
    return (
        raw.transform(drop_columns, EMPTY_CAMPAIGN_COLUMNS)
        .transform(drop_nulls, ["started_at"], fill=CAMPAIGN_FILLERS)
        .transform(cast_columns, CAMPAIGN_TYPES)
    )


def clean_clients(raw: DataFrame) -> DataFrame:
    return cast_columns(raw, {"first_purchase_date": "timestamp"})


def clean_holidays(raw: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """One row per date: the first by ``order_by``, or else by the name of the holiday."""
    first = drop_duplicates(raw, ["date"], order_by=order_by or ["holiday"])
    return cast_columns(keep_columns(first, ["date", "holiday"]), {"date": "timestamp"})


def clean_messages(raw: DataFrame) -> DataFrame:
    """Messages with typed flags and dates; also the row transform of the ingest."""
    return (
        raw.transform(drop_columns, EMPTY_MESSAGE_COLUMNS)
        .transform(fill_nulls, MESSAGE_FILLERS)
        .transform(cast_columns, MESSAGE_TYPES)
    )


def known_messages(messages: DataFrame, campaigns: DataFrame, clients: DataFrame) -> DataFrame:
    """Messages whose campaign and client are both known; either key is primary in its table."""
    return keep_referenced(
        messages, [("campaign_id", campaigns, "id"), ("client_id", clients, "client_id")], unique_keys=True
    )
