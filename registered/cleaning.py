"""Raw tables to clean ones."""

from __future__ import annotations

from tidemark import plans

from . import raw
from .tables import text


def sql_dates_as_text(columns: list[str]) -> str:
    from .tables import SQL_TIMESTAMP_TEXT

    changed = ", ".join(f"strftime(\"{c}\", '{SQL_TIMESTAMP_TEXT}') AS \"{c}\"" for c in columns)
    return f"SELECT * REPLACE ({changed})"


def dates_as_text(df, columns):
    return df.select([text(c) if c in columns else df[c] for c in df.columns])


def clean_messages(spark, sf):
    return dates_as_text(plans.clean_messages(raw.raw_messages(spark, sf)), raw.MESSAGE_DATES)


def clean_campaigns(spark, sf):
    return dates_as_text(plans.clean_campaigns(raw.raw_campaigns(spark, sf)), raw.CAMPAIGN_DATES)


def clean_clients(spark, sf):
    return dates_as_text(plans.clean_clients(raw.raw_clients(spark, sf)), ["first_purchase_date"])


def clean_holidays(spark, sf):
    return dates_as_text(plans.clean_holidays(raw.raw_holidays(spark, sf)), ["date"])


def clean_customer_records(spark, sf):
    return plans.clean_customer_records(raw.customer_records(spark, sf))


QUERIES = {
    "clean_messages": (clean_messages, f"{sql_dates_as_text(raw.MESSAGE_DATES)} FROM {raw.SQL_MESSAGES}"),
    "clean_campaigns": (clean_campaigns, f"{sql_dates_as_text(raw.CAMPAIGN_DATES)} FROM {raw.SQL_CAMPAIGNS}"),
    "clean_clients": (clean_clients, f"{sql_dates_as_text(['first_purchase_date'])} FROM {raw.SQL_CLIENTS}"),
    "clean_holidays": (clean_holidays, f"{sql_dates_as_text(['date'])} FROM {raw.SQL_HOLIDAYS}"),
    "clean_customer_records": (clean_customer_records, f"SELECT * FROM {raw.SQL_RECORDS}"),
}
