"""The batch jobs: raw tables to clean, enriched, checked and loaded ones."""

from .cleaning import clean_campaigns, clean_clients, clean_customer_records, clean_holidays, clean_messages, known_messages
from .enrichment import (
    campaign_performance,
    enriched_campaigns,
    enriched_clients,
    enriched_holidays,
    enriched_messages,
)
from .jobs import Layout, build_gold, build_silver, export_csv, ingest_messages, load_database, validate_gold
from .validation import CAMPAIGN_RULES, CLIENT_RULES, MESSAGE_RULES

__all__ = [
    "CAMPAIGN_RULES",
    "CLIENT_RULES",
    "Layout",
    "MESSAGE_RULES",
    "build_gold",
    "build_silver",
    "campaign_performance",
    "clean_campaigns",
    "clean_clients",
    "clean_customer_records",
    "clean_holidays",
    "clean_messages",
    "enriched_campaigns",
    "enriched_clients",
    "enriched_holidays",
    "enriched_messages",
    "export_csv",
    "ingest_messages",
    "known_messages",
    "load_database",
    "validate_gold",
]
