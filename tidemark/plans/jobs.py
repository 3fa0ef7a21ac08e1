"""Reading, transforming and writing the tables of one data folder.

Every table is written before another job reads it, so a lost executor or a failed
job repeats one step. Full loads overwrite; only the message ingest appends, and
its checkpoint keeps a rerun from adding rows twice.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..operators import drop_columns, keep_columns, quality_report
from ..sinks import write_csv, write_jdbc, write_parquet
from ..sources import read_csv, read_json_records, read_parquet
from ..streaming import ingest_files
from . import cleaning, enrichment, validation


@dataclass(frozen=True)
class Layout:
    """Where the tables of each stage live."""

    root: str

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def silver(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/parquet/{name}"

    def export(self, name: str) -> str:
        return f"{self.root}/gold/csv/{name}"

    def check(self, name: str) -> str:
        return f"{self.root}/checks/{name}"

    def progress(self, name: str) -> str:
        return f"{self.root}/progress/{name}"


def ingest_messages(spark: SparkSession, at: Layout, files_per_batch: int = 1000) -> None:
    """Clean the message files that arrived since the last run."""
    ingest_files(
        spark,
        folder=at.bronze("messages"),
        schema=schemas.RAW_MESSAGES,
        target=at.silver("messages"),
        checkpoint=at.progress("messages"),
        transform=cleaning.clean_messages,
        files_per_batch=files_per_batch,
    )


def build_silver(spark: SparkSession, at: Layout) -> None:
    """Clean the raw tables and keep the messages of known campaigns and clients."""
    records = read_json_records(spark, at.bronze("customers.json"), schemas.CUSTOMER_RECORDS)
    write_parquet(cleaning.clean_customer_records(records), at.silver("customers"))
    campaigns = read_csv(spark, at.bronze("campaigns.csv"), schemas.RAW_CAMPAIGNS)
    write_parquet(cleaning.clean_campaigns(campaigns), at.silver("campaigns"))
    clients = read_csv(spark, at.bronze("clients.csv"), schemas.RAW_CLIENTS)
    write_parquet(cleaning.clean_clients(clients), at.silver("clients"))
    holidays = read_csv(spark, at.bronze("holidays.csv"), schemas.RAW_HOLIDAYS, position="place")
    write_parquet(cleaning.clean_holidays(holidays, order_by=["place"]), at.silver("holidays"))
    ingest_messages(spark, at)
    tables = [read_parquet(spark, at.silver(t)) for t in ("messages", "campaigns", "clients")]
    write_parquet(cleaning.known_messages(*tables), at.silver("messages_known"))


def build_gold(spark: SparkSession, at: Layout) -> None:
    """Enrich the clean tables and total the messages per campaign."""

    def silver(name: str) -> DataFrame:
        return read_parquet(spark, at.silver(name))

    holidays = silver("holidays")
    for name, table in {
        "messages": enrichment.enriched_messages(silver("messages_known"), holidays),
        "campaigns": enrichment.enriched_campaigns(silver("campaigns"), holidays),
        "clients": enrichment.enriched_clients(silver("clients"), silver("customers")),
        "holidays": enrichment.enriched_holidays(holidays),
        "performance": enrichment.campaign_performance(silver("messages_known")),
    }.items():
        write_parquet(table, at.gold(name))
    write_csv(enrichment.campaign_performance(silver("messages")), at.export("performance_full"))


def _holiday_flags(columns: list[str]) -> list[str]:
    return [f"{c}_holiday" for c in columns]


def _table(spark: SparkSession, at: Layout, name: str) -> DataFrame:
    """A gold table without the columns that its target does not have."""
    table = read_parquet(spark, at.gold(name))
    if name == "campaigns":
        return drop_columns(table, _holiday_flags(enrichment.CAMPAIGN_DATES))
    if name == "messages":
        return drop_columns(table, ["id"])
    return table


def load_database(
    spark: SparkSession, at: Layout, url: str, properties: dict[str, str] | None = None, **options
) -> None:
    """Append the gold tables to the database, parents before children."""
    for name, target in [
        ("campaigns", "campaign"),
        ("clients", "clients"),
        ("holidays", "holidays"),
        ("messages", "messages"),
        ("performance", "agg_campaign_performance"),
    ]:
        table = _table(spark, at, name)
        if name == "messages":
            table = drop_columns(table, _holiday_flags(enrichment.MESSAGE_DATES))
        types = schemas.DATABASE_TYPES[target]
        write_jdbc(table, url, target, types=types, properties=properties, **options)


def export_csv(spark: SparkSession, at: Layout) -> None:
    """Write the gold tables as CSV."""
    for name in ["campaigns", "clients", "holidays", "messages", "performance"]:
        write_csv(_table(spark, at, name), at.export(name))


def validate_gold(spark: SparkSession, at: Layout, as_of: datetime.date | None = None) -> dict[str, DataFrame]:
    """Write and return the quality report of each exported table."""
    reports = {}
    for name, schema, rules in [
        ("campaigns", schemas.GOLD_CAMPAIGNS, validation.CAMPAIGN_RULES),
        ("clients", schemas.GOLD_CLIENTS, validation.CLIENT_RULES),
        ("messages", schemas.GOLD_MESSAGES, validation.MESSAGE_RULES),
    ]:
        # The exports hold timestamps in ISO form.
        table = read_csv(spark, at.export(name), schema)
        report = quality_report(table, rules, as_of=as_of, date_formats=None)
        # One row per rule: a single small file in the order of the rules.
        ordered = report.orderBy("orden").coalesce(1)
        write_csv(keep_columns(ordered, ["columna", "regla", "estado", "detalle"]), at.check(name))
        reports[name] = report
    return reports
