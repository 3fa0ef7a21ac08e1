"""Column types of the raw tables. Dates and flags are text until they are cleaned."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"BIGINT": T.LongType(), "DOUBLE": T.DoubleType(), "STRING": T.StringType(), "BOOLEAN": T.BooleanType()}


def _struct(columns: str) -> T.StructType:
    """``name TYPE`` pairs; unlike ``fromDDL`` this needs no session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# --- Fixed values: columns of the raw and the enriched tables ---
RAW_CAMPAIGNS = _struct(
    """id BIGINT, campaign_type STRING, channel STRING, topic STRING, started_at STRING,
    finished_at STRING, total_count DOUBLE, ab_test STRING, warmup_mode STRING, hour_limit DOUBLE,
    subject_length DOUBLE, subject_with_personalization STRING, subject_with_deadline STRING,
    subject_with_emoji STRING, subject_with_bonuses STRING, subject_with_discount STRING,
    subject_with_saleout STRING, is_test STRING, position STRING"""
)

RAW_CLIENTS = _struct("client_id BIGINT, first_purchase_date STRING")

RAW_HOLIDAYS = _struct("date STRING, holiday STRING")

RAW_MESSAGES = _struct(
    """id BIGINT, message_id STRING, campaign_id BIGINT, message_type STRING, client_id BIGINT,
    channel STRING, category STRING, platform STRING, email_provider STRING, stream STRING,
    date STRING, sent_at STRING, is_opened STRING, opened_first_time_at STRING,
    opened_last_time_at STRING, is_clicked STRING, clicked_first_time_at STRING,
    clicked_last_time_at STRING, is_unsubscribed STRING, unsubscribed_at STRING,
    is_hard_bounced STRING, hard_bounced_at STRING, is_soft_bounced STRING, soft_bounced_at STRING,
    is_complained STRING, complained_at STRING, is_blocked STRING, blocked_at STRING,
    is_purchased STRING, purchased_at STRING, created_at STRING, updated_at STRING"""
)

CUSTOMER_RECORDS = _struct(
    """id STRING, gender STRING, age BIGINT, country STRING, city STRING, preferred_channel STRING,
    loyalty_level STRING, average_purchase_value DOUBLE, churn_risk DOUBLE"""
)

# Gold tables as read back from CSV for validation: numbers and flags typed, dates as text.
GOLD_CAMPAIGNS = _struct(
    """id BIGINT, campaign_type STRING, channel STRING, topic STRING, started_at STRING,
    finished_at STRING, total_count BIGINT, warmup_mode BOOLEAN, subject_length BIGINT,
    subject_with_personalization BOOLEAN, subject_with_deadline BOOLEAN, subject_with_emoji BOOLEAN,
    subject_with_bonuses BOOLEAN, subject_with_discount BOOLEAN, subject_with_saleout BOOLEAN"""
)

GOLD_CLIENTS = _struct(
    """client_id BIGINT, first_purchase_date STRING, gender STRING, age BIGINT, country STRING,
    city STRING, preferred_channel STRING, loyalty_level STRING, average_purchase_value DOUBLE,
    churn_risk DOUBLE"""
)

GOLD_MESSAGES = _struct(
    """message_id STRING, campaign_id BIGINT, client_id BIGINT, channel STRING, platform STRING,
    date STRING, opened_first_time_at STRING, is_opened BOOLEAN, is_clicked BOOLEAN,
    is_unsubscribed BOOLEAN, is_hard_bounced BOOLEAN, is_soft_bounced BOOLEAN,
    is_complained BOOLEAN, is_blocked BOOLEAN, is_purchased BOOLEAN"""
)

# Types of the database columns where they differ from the DataFrame's.
DATABASE_TYPES = {
    "campaign": {"total_count": "int", "subject_length": "int"},
    "clients": {
        "first_purchase_date": "date",
        "age": "int",
        "average_purchase_value": "decimal(10,2)",
        "churn_risk": "decimal(4,2)",
    },
    "holidays": {"date": "date"},
    "messages": {},
    "agg_campaign_performance": {
        **dict.fromkeys(
            [
                "campaign_id",
                "total_sent",
                "total_opened",
                "total_clicked",
                "total_purchased",
                "total_unsubscribed",
                "total_bounced",
            ],
            "int",
        ),
        **dict.fromkeys(
            ["open_rate", "click_rate", "conversion_rate", "unsubscribe_rate", "bounce_rate"],
            "decimal(5,2)",
        ),
    },
}
