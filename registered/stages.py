"""Clean tables to enriched and aggregated ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import plans
from tidemark.operators import merge

from . import raw
from .aggregates import sql_rates
from .cleaning import dates_as_text, sql_dates_as_text
from .tables import longs

SQL_KNOWN = f"""(SELECT * FROM {raw.SQL_MESSAGES} WHERE campaign_id IN (SELECT id FROM {raw.SQL_CAMPAIGNS})
    AND client_id IN (SELECT client_id FROM {raw.SQL_CLIENTS}))"""
SQL_TOTALS = {
    "opened": "is_opened",
    "clicked": "is_clicked",
    "purchased": "is_purchased",
    "unsubscribed": "is_unsubscribed",
    "bounced": "is_hard_bounced OR is_soft_bounced",
}


def _messages(spark, sf):
    return plans.clean_messages(raw.raw_messages(spark, sf))


def _campaigns(spark, sf):
    return plans.clean_campaigns(raw.raw_campaigns(spark, sf))


def _clients(spark, sf):
    return plans.clean_clients(raw.raw_clients(spark, sf))


def _holidays(spark, sf):
    return plans.clean_holidays(raw.raw_holidays(spark, sf))


def _known(spark, sf):
    return plans.known_messages(_messages(spark, sf), _campaigns(spark, sf), _clients(spark, sf))


def known_messages(spark, sf):
    return _known(spark, sf).select("id", "message_id", "campaign_id", "client_id")


def enriched_messages(spark, sf):
    flagged = plans.enriched_messages(_known(spark, sf), _holidays(spark, sf))
    return flagged.select("message_id", *[f"{c}_holiday" for c in raw.MESSAGE_DATES])


def enriched_campaigns(spark, sf):
    flagged = plans.enriched_campaigns(_campaigns(spark, sf), _holidays(spark, sf))
    return flagged.select("id", *[f"{c}_holiday" for c in raw.CAMPAIGN_DATES])


def _sql_flags(columns: list[str]) -> str:
    return ", ".join(f'CAST("{c}" AS DATE) IN {raw.SQL_HOLIDAY_DAYS} AS "{c}_holiday"' for c in columns)


def enriched_clients(spark, sf):
    records = plans.clean_customer_records(raw.customer_records(spark, sf))
    return dates_as_text(plans.enriched_clients(_clients(spark, sf), records), ["first_purchase_date"])


ENRICHED_CLIENTS = f"""
{sql_dates_as_text(['first_purchase_date'])}
FROM (SELECT client_id, first_purchase_date, coalesce(gender, 'other') AS gender, coalesce(age, 18) AS age,
             coalesce(country, 'Colombia') AS country, coalesce(city, 'Bogotá') AS city,
             coalesce(preferred_channel, 'unknow') AS preferred_channel,
             coalesce(loyalty_level, 'unsubscribed') AS loyalty_level,
             coalesce(average_purchase_value, 0) AS average_purchase_value, coalesce(churn_risk, 0) AS churn_risk
      FROM {raw.SQL_CLIENTS} c LEFT JOIN {raw.SQL_RECORDS} r ON c.client_id = r.id)"""


def enriched_holidays(spark, sf):
    named = plans.enriched_holidays(_holidays(spark, sf))
    return longs(dates_as_text(named, ["date"]), "day", "month", "year")


ENRICHED_HOLIDAYS = f"""
{sql_dates_as_text(['date'])}
FROM (SELECT "date", holiday, day("date") AS day, month("date") AS month, year("date") AS year,
      (['Lunes', 'Martes', 'Miercoles', 'Jueves', 'Viernes', 'Sabado', 'Domingo'])[isodow("date")] AS weekday
      FROM {raw.SQL_HOLIDAYS})"""


def campaign_performance(spark, sf):
    return plans.campaign_performance(_known(spark, sf))


def campaign_performance_full(spark, sf):
    """All messages, of unknown campaigns and clients as well."""
    return plans.campaign_performance(_messages(spark, sf))


def campaign_leaders(spark, sf):
    """Fan-in and fan-out: the performance joined back to its campaigns."""
    totals = plans.campaign_performance(_known(spark, sf)).select("campaign_id", "total_sent", "open_rate")
    joined = merge(_campaigns(spark, sf), totals, left_on="id", right_on="campaign_id", how="left", unique="right")
    return joined.groupBy("channel").agg(
        F.count(F.lit(1)).alias("campaigns"), F.sum("total_sent").alias("sent"), F.max("open_rate").alias("best_open_rate")
    )


CAMPAIGN_LEADERS = f"""
SELECT channel, count(*) AS campaigns, CAST(sum(total_sent) AS BIGINT) AS sent, max(open_rate) AS best_open_rate
FROM {raw.SQL_CAMPAIGNS} c
LEFT JOIN ({sql_rates('campaign_id', 'message_id', SQL_KNOWN, SQL_TOTALS)}) p ON c.id = p.campaign_id
GROUP BY channel"""

QUERIES = {
    "known_messages": (known_messages, f"SELECT id, message_id, campaign_id, client_id FROM {SQL_KNOWN}"),
    "enriched_messages": (enriched_messages, f"SELECT message_id, {_sql_flags(raw.MESSAGE_DATES)} FROM {SQL_KNOWN}"),
    "enriched_campaigns": (enriched_campaigns, f"SELECT id, {_sql_flags(raw.CAMPAIGN_DATES)} FROM {raw.SQL_CAMPAIGNS}"),
    "enriched_clients": (enriched_clients, ENRICHED_CLIENTS),
    "enriched_holidays": (enriched_holidays, ENRICHED_HOLIDAYS),
    "campaign_performance": (campaign_performance, sql_rates("campaign_id", "message_id", SQL_KNOWN, SQL_TOTALS)),
    "campaign_performance_full": (
        campaign_performance_full,
        sql_rates("campaign_id", "message_id", raw.SQL_MESSAGES, SQL_TOTALS),
    ),
    "campaign_leaders": (campaign_leaders, CAMPAIGN_LEADERS),
}
