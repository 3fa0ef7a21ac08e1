"""Raw campaign tables derived from the supplied ones, and their clean form in SQL.

Events become messages, suppliers campaigns, customers clients, and the days of
events holidays. Flags are ``t``/``f``, dates are text, and some cells are null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .tables import table

_FLAGS = {
    "is_opened": "event_type IN ('view', 'click', 'purchase')",
    "is_clicked": "event_type IN ('click', 'purchase')",
    "is_unsubscribed": "event_type = 'signup'",
    "is_hard_bounced": "event_type = 'error' AND value > 50",
    "is_soft_bounced": "event_type = 'error' AND value <= 50",
    "is_complained": "event_type = 'error' AND value > 400",
    "is_purchased": "event_type = 'purchase'",
}
# --- Fixed values: columns of the raw messages that are empty ---
_NO_CELLS = [
    "category",
    "clicked_first_time_at",
    "clicked_last_time_at",
    "unsubscribed_at",
    "hard_bounced_at",
    "soft_bounced_at",
    "complained_at",
    "blocked_at",
    "purchased_at",
]
_LABELS = """event_id AS id, concat('m', event_id) AS message_id, user_id AS campaign_id,
    CASE WHEN value < 200 THEN 'bulk' ELSE 'trigger' END AS message_type,
    CAST(floor(value * 3) AS BIGINT) AS client_id,
    CASE WHEN event_type = 'view' THEN 'email' ELSE 'mobile_push' END AS channel, event_type AS stream"""


def raw_messages(spark, sf) -> DataFrame:
    flags = [f"CASE WHEN {c} THEN 't' ELSE 'f' END AS {n}" for n, c in _FLAGS.items()]
    nothing = [f"CAST(NULL AS STRING) AS {n}" for n in _NO_CELLS]
    sent = "date_format({}, 'yyyy-MM-dd HH:mm:ss')"
    return table(spark, sf, "events").selectExpr(
        *[c.strip() for c in _split(_LABELS)],
        "CASE WHEN event_type <> 'click' THEN 'desktop' END AS platform",
        "CASE WHEN event_type IN ('view', 'signup') THEN 'mail.example' END AS email_provider",
        "date_format(ts, 'yyyy-MM-dd') AS date",
        f"{sent.format('ts')} AS sent_at",
        f"CASE WHEN {_FLAGS['is_opened']} THEN {sent.format('date_add(ts, 1)')} END AS opened_first_time_at",
        "CASE WHEN event_type = 'purchase' THEN date_format(date_add(ts, 2), 'yyyy-MM-dd') END AS opened_last_time_at",
        *flags,
        "CASE WHEN event_type <> 'error' THEN 'f' END AS is_blocked",
        *nothing,
        f"{sent.format('ts')} AS created_at",
        f"{sent.format('ts')} AS updated_at",
    )


def _split(select: str) -> list[str]:
    """The top-level items of a select list."""
    items, depth, start = [], 0, 0
    for i, c in enumerate(select):
        depth += (c == "(") - (c == ")")
        if c == "," and depth == 0:
            items.append(select[start:i])
            start = i + 1
    return items + [select[start:]]


_SQL_FLAGS = ", ".join(f"{c} AS {n}" for n, c in _FLAGS.items())
SQL_MESSAGES = f"""(SELECT {_LABELS},
    CASE WHEN event_type <> 'click' THEN 'desktop' ELSE 'unknow' END AS platform,
    CASE WHEN event_type IN ('view', 'signup') THEN 'mail.example' ELSE 'unknow' END AS email_provider,
    CAST(CAST(ts AS DATE) AS TIMESTAMP) AS "date", date_trunc('second', ts) AS sent_at,
    CASE WHEN {_FLAGS['is_opened']} THEN CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) END AS opened_first_time_at,
    CASE WHEN event_type = 'purchase' THEN CAST(CAST(ts AS DATE) + 2 AS TIMESTAMP) END AS opened_last_time_at,
    {_SQL_FLAGS}, CASE WHEN event_type <> 'error' THEN false END AS is_blocked
    FROM events)"""
MESSAGE_DATES = ["date", "sent_at", "opened_first_time_at", "opened_last_time_at"]

_CAMPAIGN_FLAGS = {
    "warmup_mode": ("CASE WHEN s_nationkey < 5 THEN 't' ELSE 'f' END", "s_nationkey < 5"),
    "subject_with_personalization": ("CASE WHEN s_acctbal > 0 THEN 'true' ELSE 'FALSE' END", "s_acctbal > 0"),
    "subject_with_deadline": ("CASE WHEN s_nationkey < 12 THEN '1' ELSE '0' END", "s_nationkey < 12"),
    "subject_with_emoji": ("CASE WHEN s_nationkey < 12 THEN 'si' END", "CASE WHEN s_nationkey < 12 THEN true END"),
    "subject_with_bonuses": ("CASE WHEN s_nationkey < 12 THEN 'maybe' ELSE 'n' END", "CASE WHEN s_nationkey >= 12 THEN false END"),
    "subject_with_discount": ("'f'", "false"),
    "subject_with_saleout": ("'Yes'", "true"),
}
_CAMPAIGN_CHANNEL = "CASE WHEN s_acctbal < 0 THEN NULL WHEN s_nationkey < 10 THEN 'email' ELSE 'whatsapp' END"


def raw_campaigns(spark, sf) -> DataFrame:
    return table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS id",
        "'bulk' AS campaign_type",
        f"{_CAMPAIGN_CHANNEL} AS channel",
        "CASE WHEN s_nationkey < 20 THEN concat('sale, \"', s_name, '\"') END AS topic",
        "CASE WHEN s_nationkey <> 7 THEN concat(date_add(DATE'2024-01-01', s_nationkey), ' 07:22:36.615023') END AS started_at",
        "CASE WHEN s_nationkey < 12 THEN concat(date_add(DATE'2024-01-10', s_nationkey), 'T23:00:00') END AS finished_at",
        "CASE WHEN s_nationkey >= 5 THEN CAST(s_suppkey * 10 AS DOUBLE) END AS total_count",
        "CAST(NULL AS STRING) AS ab_test",
        "CAST(NULL AS DOUBLE) AS hour_limit",
        "CASE WHEN s_nationkey >= 3 THEN 57.0D END AS subject_length",
        *[f"{raw} AS {name}" for name, (raw, _) in _CAMPAIGN_FLAGS.items()],
        "CAST(NULL AS STRING) AS is_test",
        "CAST(NULL AS STRING) AS position",
    )


SQL_CAMPAIGNS = f"""(SELECT s_suppkey AS id, 'bulk' AS campaign_type,
    coalesce({_CAMPAIGN_CHANNEL}, 'unknow') AS channel,
    CASE WHEN s_nationkey < 20 THEN concat('sale, "', s_name, '"') ELSE 'unknow' END AS topic,
    DATE '2024-01-01' + s_nationkey + TIME '07:22:36.615023' AS started_at,
    CASE WHEN s_nationkey < 12 THEN DATE '2024-01-10' + s_nationkey + TIME '23:00:00' END AS finished_at,
    CASE WHEN s_nationkey >= 5 THEN s_suppkey * 10 ELSE 0 END AS total_count,
    CAST(CASE WHEN s_nationkey >= 3 THEN 57 ELSE 0 END AS BIGINT) AS subject_length,
    {', '.join(f'{clean} AS {name}' for name, (_, clean) in _CAMPAIGN_FLAGS.items())}
    FROM supplier WHERE s_nationkey <> 7)"""
CAMPAIGN_DATES = ["started_at", "finished_at"]


# Some customers get a key that nothing else has.
_CLIENT_KEY = "CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_custkey ELSE c_custkey + 20000000 END"
_RECORD_KEY = "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN c_custkey ELSE c_custkey + 30000000 END"


def raw_clients(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").selectExpr(
        f"{_CLIENT_KEY} AS client_id", "date_format(date_add(DATE'2023-02-01', c_nationkey), 'yyyy-MM-dd') AS first_purchase_date"
    )


SQL_CLIENTS = f"""(SELECT {_CLIENT_KEY} AS client_id, CAST(DATE '2023-02-01' + c_nationkey AS TIMESTAMP) AS first_purchase_date
    FROM customer)"""

# Days of events that are no holidays are moved out of the way, a hundred years back.
_HOLIDAY = "event_type = 'signup' AND dayofmonth(ts) IN (1, 6, 14, 25) AND value < 300"
_HOLIDAY_DAY = f"CASE WHEN {_HOLIDAY} THEN CAST(ts AS DATE) ELSE CAST(ts - INTERVAL '100' YEAR AS DATE) END"


def raw_holidays(spark, sf) -> DataFrame:
    """Many rows per date, of which one is to be kept."""
    return table(spark, sf, "events").selectExpr(
        f"date_format({_HOLIDAY_DAY}, 'yyyy-MM-dd') AS date", "concat('Fiesta ', user_id) AS holiday"
    )


SQL_HOLIDAYS = f"""(SELECT CAST({_HOLIDAY_DAY} AS TIMESTAMP) AS "date", min(concat('Fiesta ', user_id)) AS holiday
    FROM events GROUP BY 1)"""
# The job keeps the first row of a date as the file holds them.
SQL_FIRST_HOLIDAYS = f"""(SELECT CAST({_HOLIDAY_DAY} AS TIMESTAMP) AS "date", arg_min(concat('Fiesta ', user_id), event_id) AS holiday
    FROM events GROUP BY 1)"""
SQL_HOLIDAY_DAYS = f"(SELECT {_HOLIDAY_DAY} FROM events)"


def customer_records(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").selectExpr(
        f"CAST({_RECORD_KEY} AS STRING) AS id",
        "CASE WHEN c_acctbal < 0 THEN 'female' ELSE 'male' END AS gender",
        "CAST(c_nationkey + 15 AS BIGINT) AS age",
        "'Perú' AS country",
        "c_mktsegment AS city",
        "CASE WHEN c_nationkey < 3 THEN NULL ELSE 'push' END AS preferred_channel",
        "'silver' AS loyalty_level",
        "c_acctbal AS average_purchase_value",
        "c_nationkey / 100.0D AS churn_risk",
    )


SQL_RECORDS = f"""(SELECT {_RECORD_KEY} AS id, CASE WHEN c_acctbal < 0 THEN 'female' ELSE 'male' END AS gender,
    CAST(c_nationkey + 15 AS BIGINT) AS age, 'Perú' AS country, c_mktsegment AS city,
    CASE WHEN c_nationkey < 3 THEN NULL ELSE 'push' END AS preferred_channel, 'silver' AS loyalty_level,
    c_acctbal AS average_purchase_value, c_nationkey / 100.0::DOUBLE AS churn_risk
    FROM customer)"""
