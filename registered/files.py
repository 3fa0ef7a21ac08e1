"""Round trips through files in the shared folder, ingest and whole job chains."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import plans
from tidemark.operators import cast_columns, number_rows
from tidemark.schemas import RAW_MESSAGES
from tidemark.session import fresh_path
from tidemark.sinks import write_batches, write_csv, write_feed, write_one_csv, write_parquet
from tidemark.sources import infer_schema, read_csv, read_json_records, read_parquet
from tidemark.streaming import add_totals, compact_totals, ingest_batches, ingest_files, read_totals

from . import raw
from .aggregates import sql_rates
from .quality import sql_counter, sql_fixed, sql_null_share, sql_report
from .stages import SQL_KNOWN, SQL_TOTALS
from .tables import longs, table

_RECORDS_PER_LINE = 100


def json_records(spark, sf):
    """Customers landed as arrays of up to 100 objects per line, as a paged API gives them."""
    customers = table(spark, sf, "customer")
    page = F.floor(F.col("c_custkey") / _RECORDS_PER_LINE)
    pages = customers.groupBy(page.alias("page")).agg(
        F.to_json(F.collect_list(F.struct("c_custkey", "c_name", "c_acctbal", "c_mktsegment"))).alias("value")
    )
    path = fresh_path(spark, "records")
    pages.select("value").write.text(path)
    return read_json_records(
        spark, path, "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE, c_mktsegment STRING, c_phone STRING"
    )


JSON_RECORDS = "SELECT c_custkey, c_name, c_acctbal, c_mktsegment, NULL::VARCHAR AS c_phone FROM customer"


def json_selected(spark, sf):
    """Two fields of the JSON objects that the events carry, over all rows."""
    path = fresh_path(spark, "props")
    table(spark, sf, "events").select("props").write.text(path)
    records = read_json_records(spark, path, "k BIGINT, unused STRING", columns=["k"])
    return records.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


JSON_SELECTED = """
SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1"""


def _awkward_cells(spark, sf):
    """Separators, quotes, nulls and empty texts."""
    return table(spark, sf, "customer").selectExpr(
        "c_custkey",
        "CASE WHEN c_nationkey < 5 THEN concat('say \"', c_name, '\"; ok') WHEN c_nationkey < 15 THEN c_name END AS c_name",
        "CASE WHEN c_nationkey < 8 THEN '' WHEN c_nationkey < 16 THEN 'back\\\\slash' END AS note",
        "CASE WHEN c_acctbal > 0 THEN c_acctbal END AS c_acctbal",
    )


_SQL_AWKWARD_CELLS = """
SELECT c_custkey,
       CASE WHEN c_nationkey < 5 THEN concat('say "', c_name, '"; ok') WHEN c_nationkey < 15 THEN c_name END AS c_name,
       CASE WHEN c_nationkey < 8 THEN '' WHEN c_nationkey < 16 THEN 'back\\slash' END AS note,
       CASE WHEN c_acctbal > 0 THEN c_acctbal END AS c_acctbal
FROM customer"""


def csv_roundtrip(spark, sf):
    cells = _awkward_cells(spark, sf)
    path = write_csv(cells, fresh_path(spark, "csv"), sep=";")
    return read_csv(spark, path, cells.schema, sep=";")


def csv_columns_by_name(spark, sf):
    """The schema names some columns, in another order than the file."""
    path = write_csv(table(spark, sf, "part"), fresh_path(spark, "csv"))
    return read_csv(spark, path, "p_size INT, p_partkey BIGINT", columns=["p_partkey", "p_size"])


CSV_COLUMNS_BY_NAME = "SELECT p_partkey, p_size FROM part"


def csv_inferred(spark, sf):
    """Inferred types: whole numbers, decimals, flags; dates stay text."""
    customers = table(spark, sf, "customer").selectExpr(
        "c_custkey", "c_acctbal", "c_acctbal > 0 AS active", "c_mktsegment", "DATE'2024-01-01' AS since",
        "CASE WHEN c_nationkey < 10 THEN c_nationkey END AS nation",
    )
    path = write_csv(customers, fresh_path(spark, "csv"))
    return read_csv(spark, path, infer_schema(spark, path))


CSV_INFERRED = """
SELECT c_custkey, c_acctbal, c_acctbal > 0 AS active, c_mktsegment, '2024-01-01' AS since,
       CAST(CASE WHEN c_nationkey < 10 THEN c_nationkey END AS BIGINT) AS nation FROM customer"""


def csv_append(spark, sf):
    """Three batches: the first overwrites, the others are added."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    batches = [orders.filter(F.col("o_orderstatus") == s) for s in ("F", "O", "P")]
    path = write_batches(spark, batches, fresh_path(spark, "csv"), write=write_csv)
    return read_csv(spark, path, orders.schema)


CSV_APPEND = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')"


def csv_folder(spark, sf):
    """All CSV files of a folder but the excluded ones: those of a second copy of the rows."""
    suppliers = table(spark, sf, "supplier")
    path = write_csv(suppliers, fresh_path(spark, "csv"))
    first = _file_names(spark, path)
    write_csv(suppliers, path, mode="append")
    return read_csv(spark, folder=path, schema=suppliers.schema, exclude=sorted(_file_names(spark, path) - first))


def csv_line_breaks(spark, sf):
    """Whole texts with line breaks, quotes and separators as CSV cells."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return read_csv(spark, write_csv(docs, fresh_path(spark, "csv")), docs.schema)


CSV_LINE_BREAKS = "SELECT doc_id, text, lang, source FROM documents"


def csv_chunk(spark, sf):
    """The second chunk of 150 rows of the texts as CSV files hold them."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    path = write_csv(docs.orderBy("doc_id"), fresh_path(spark, "csv"))
    return read_csv(spark, path, docs.schema, chunk=(1, 150))


CSV_CHUNK = """
SELECT doc_id, text, lang FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS place FROM documents)
WHERE place BETWEEN 151 AND 300"""


def csv_one_file(spark, sf):
    """A sorted table as one file with one header: every row and its place in the file."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    path = write_one_csv(orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey"), fresh_path(spark, "one"))
    return number_rows(read_csv(spark, path, orders.schema, position="at"), ["at"], "place").drop("at")


CSV_ONE_FILE = """
SELECT o_orderkey, o_totalprice, o_orderpriority, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS place
FROM orders"""


def _make_old(folder, names):
    """Set the files' times back by ten days, where the folder is a local or mounted one."""
    local = folder.removeprefix("file://")
    for name in names if os.path.isdir(local) else ():
        then = os.path.getmtime(os.path.join(local, name)) - 10 * 86400
        os.utime(os.path.join(local, name), (then, then))


def _file_names(spark, path):
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).select("path")
    return {row["path"].rpartition("/")[2] for row in files.collect()}


CSV_FOLDER = "SELECT * FROM supplier"


def parquet_append(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = fresh_path(spark, "parquet")
    write_parquet(orders.filter("o_totalprice < 1"), path)
    write_parquet(orders, path, mode="overwrite", compression="zstd")
    write_parquet(orders.filter("o_orderstatus = 'F'"), path, mode="append")
    return read_parquet(spark, path)


PARQUET_APPEND = """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'"""


def parquet_partitioned(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = write_parquet(orders, fresh_path(spark, "parquet"), partition_by=["o_orderstatus"])
    return read_parquet(spark, path).filter("o_orderstatus = 'F'")


PARQUET_PARTITIONED = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'"


def parquet_folder(spark, sf):
    """All Parquet files of the data folder but the other tables' ones."""
    others = ["region", "nation", "customer", "supplier", "part", "lineitem", "events", "documents"]
    others += ["embeddings", "pages", "benchmark", "labels", "conversations"]
    return read_parquet(
        spark, folder=sf, columns=["o_orderkey", "o_custkey"], exclude=[f"{t}.parquet" for t in others]
    )


PARQUET_FOLDER = "SELECT o_orderkey, o_custkey FROM orders"


def incremental_ingest(spark, sf):
    """Three arrivals of files, the last one of old files, with a rerun in between; every row comes in once."""
    events = table(spark, sf, "events").selectExpr(
        "event_id", "CAST(user_id AS STRING) AS user", "CASE WHEN value > 100 THEN 't' ELSE 'f' END AS high", "event_type"
    )
    folder, target = fresh_path(spark, "arrivals"), fresh_path(spark, "ingested")
    checkpoint = fresh_path(spark, "progress")

    def ingest():
        ingest_files(
            spark,
            folder,
            events.schema,
            target,
            checkpoint,
            transform=lambda rows: cast_columns(rows, {"user": "int", "high": "bool"}),
            files_per_batch=4,
        )

    write_csv(events.filter("event_type IN ('view', 'click')"), folder)
    ingest()
    ingest()
    before = _file_names(spark, folder)
    write_csv(events.filter("event_type = 'error'"), folder, mode="append")
    _make_old(folder, _file_names(spark, folder) - before)
    write_csv(events.filter("event_type NOT IN ('view', 'click', 'error')"), folder, mode="append")
    ingest()
    return read_parquet(spark, target)


INCREMENTAL_INGEST = 'SELECT event_id, user_id AS "user", value > 100 AS high, event_type FROM events'


def ingest_to_csv(spark, sf):
    """Arrivals of texts with line breaks, added as CSV batches; the second run starts from a lost checkpoint
    and replaces the first one's batches."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    folder, target = fresh_path(spark, "arrivals"), fresh_path(spark, "batches")
    write_csv(docs.filter("doc_id % 3 < 2"), folder)
    for _ in range(2):
        checkpoint = fresh_path(spark, "progress")
        ingest_batches(spark, folder, docs.schema, target, checkpoint, target_format="csv", files_per_batch=3)
    write_csv(docs.filter("doc_id % 3 = 2"), folder, mode="append")
    ingest_batches(spark, folder, docs.schema, target, checkpoint, target_format="csv", files_per_batch=3)
    return read_csv(spark, target, docs.schema, nested=True)


INGEST_TO_CSV = "SELECT doc_id, text, source FROM documents"


def ingest_line_breaks(spark, sf):
    """Texts with line breaks, added to a Parquet table in two runs."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    folder, target = fresh_path(spark, "arrivals"), fresh_path(spark, "ingested")
    checkpoint = fresh_path(spark, "progress")
    for part in ("lang = 'en'", "lang <> 'en'"):
        write_csv(docs.filter(part), folder, mode="append")
        ingest_files(spark, folder, docs.schema, target, checkpoint, multiline=True)
    return read_parquet(spark, target, nested=True)


INGEST_LINE_BREAKS = "SELECT doc_id, text, lang FROM documents"


def feed_batches(spark, sf):
    """A feed of four batches that is taken up again from its third one."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    path = fresh_path(spark, "feed")
    feed = [orders.filter(F.col("o_orderkey") % 4 == k) for k in range(4)]
    write_feed(spark, iter(feed[:3]), path)
    write_feed(spark, iter(feed[2:]), path, first=2)
    return read_parquet(spark, path, nested=True)


FEED_BATCHES = "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders"


def performance_kept(spark, sf):
    """Totals and rates per campaign of three arrivals of messages, each counted once and folded in between."""
    messages = plans.clean_messages(raw.raw_messages(spark, sf))
    folder, target, checkpoint = (fresh_path(spark, name) for name in ("messages", "totals", "progress"))
    campaigns, clients = plans.clean_campaigns(raw.raw_campaigns(spark, sf)), plans.clean_clients(raw.raw_clients(spark, sf))
    for part in range(3):
        arrived = messages.filter(F.pmod(F.xxhash64("message_id"), F.lit(3)) == part)
        write_parquet(arrived, folder, mode="append")
        add_totals(
            spark, folder, messages.schema, target, checkpoint, transform=lambda m: plans.known_messages(m, campaigns, clients)
        )
        if part == 1:
            compact_totals(spark, target)
    return read_totals(spark, target)


def _bronze(spark, sf) -> plans.Layout:
    at = plans.Layout(fresh_path(spark, "campaigns"))
    write_csv(raw.raw_campaigns(spark, sf), at.bronze("campaigns.csv"))
    write_csv(raw.raw_clients(spark, sf), at.bronze("clients.csv"))
    write_csv(raw.raw_holidays(spark, sf), at.bronze("holidays.csv"))
    write_csv(raw.raw_messages(spark, sf).select(*RAW_MESSAGES.names), at.bronze("messages"))
    raw.customer_records(spark, sf).write.json(at.bronze("customers.json"))
    return at


def jobs_performance(spark, sf):
    """All cleaning and enrichment jobs from raw files to the performance table."""
    at = _bronze(spark, sf)
    plans.build_silver(spark, at)
    plans.build_gold(spark, at)
    return read_parquet(spark, at.gold("performance"))


def jobs_validation(spark, sf):
    """The whole chain from raw files to the reports on the exported tables."""
    at = _bronze(spark, sf)
    plans.build_silver(spark, at)
    plans.build_gold(spark, at)
    plans.export_csv(spark, at)
    reports = plans.validate_gold(spark, at)
    named = [longs(df, "orden").withColumn("tabla", F.lit(name)) for name, df in reports.items()]
    return reduce(DataFrame.unionAll, named)


def _exported(spark, sf) -> plans.Layout:
    at = _bronze(spark, sf)
    plans.build_silver(spark, at)
    plans.build_gold(spark, at)
    plans.export_csv(spark, at)
    return at


def jobs_export_performance(spark, sf):
    """The performance table as read back from its CSV export."""
    at = _exported(spark, sf)
    return read_csv(spark, at.export("performance"), read_parquet(spark, at.gold("performance")).schema)


def jobs_export_holidays(spark, sf):
    """The enriched holidays as read back from their CSV export."""
    exported = read_csv(spark, _exported(spark, sf).export("holidays"), "day BIGINT, month BIGINT, year BIGINT")
    return exported.withColumn("date", F.substring("date", 1, 10))


JOBS_EXPORT_HOLIDAYS = f"""
SELECT strftime("date", '%Y-%m-%d') AS "date", holiday, day("date") AS day, month("date") AS month, year("date") AS year,
       (['Lunes', 'Martes', 'Miercoles', 'Jueves', 'Viernes', 'Sabado', 'Domingo'])[isodow("date")] AS weekday
FROM {raw.SQL_FIRST_HOLIDAYS}"""


def _jobs_validation_sql() -> str:
    def flags(names):
        return [sql_fixed(n, "validacion_boolean", False, f"Columna '{n}' es tipo booleano.") for n in names]

    def not_null(column):
        return sql_counter(column, "no_nulos", f"count(*) FILTER ({column} IS NULL)", "valores nulos")

    def dates(column):
        return sql_counter(column, "formato_fecha", "0 * count(*)", "fechas no reconocidas")

    reports = {
        "campaigns": sql_report(
            raw.SQL_CAMPAIGNS,
            [
                not_null("id"),
                not_null("channel"),
                dates("started_at"),
                sql_null_share("finished_at"),
                *flags([c for c, _ in plans.CAMPAIGN_RULES[4:]]),
            ],
        ),
        "clients": sql_report(
            f"""(SELECT c.*, coalesce(r.age, 18) AS age, coalesce(r.average_purchase_value, 0) AS spent
                FROM {raw.SQL_CLIENTS} c LEFT JOIN {raw.SQL_RECORDS} r ON c.client_id = r.id)""",
            [
                not_null("client_id"),
                sql_counter("age", "edad_mayor_18", "count(*) FILTER (age < 18)", "registros con edad menor a 18"),
                sql_counter(
                    "average_purchase_value", "valores_positivos", "count(*) FILTER (spent < 0)", "valores negativos"
                ),
                dates("first_purchase_date"),
            ],
        ),
        "messages": sql_report(
            SQL_KNOWN,
            [
                *[not_null(c) for c in ("client_id", "campaign_id", "channel", "platform")],
                dates("date"),
                sql_null_share("opened_first_time_at"),
                *flags([c for c, _ in plans.MESSAGE_RULES[6:]]),
            ],
        ),
    }
    return " UNION ALL ".join(f"SELECT *, '{name}' AS tabla FROM ({sql})" for name, sql in reports.items())


QUERIES = {
    "json_records": (json_records, JSON_RECORDS),
    "json_selected": (json_selected, JSON_SELECTED),
    "csv_roundtrip": (csv_roundtrip, _SQL_AWKWARD_CELLS),
    "csv_columns_by_name": (csv_columns_by_name, CSV_COLUMNS_BY_NAME),
    "csv_inferred": (csv_inferred, CSV_INFERRED),
    "csv_append": (csv_append, CSV_APPEND),
    "csv_folder": (csv_folder, CSV_FOLDER),
    "parquet_append": (parquet_append, PARQUET_APPEND),
    "parquet_partitioned": (parquet_partitioned, PARQUET_PARTITIONED),
    "parquet_folder": (parquet_folder, PARQUET_FOLDER),
    "csv_line_breaks": (csv_line_breaks, CSV_LINE_BREAKS),
    "csv_chunk": (csv_chunk, CSV_CHUNK),
    "csv_one_file": (csv_one_file, CSV_ONE_FILE),
    "ingest_to_csv": (ingest_to_csv, INGEST_TO_CSV),
    "ingest_line_breaks": (ingest_line_breaks, INGEST_LINE_BREAKS),
    "feed_batches": (feed_batches, FEED_BATCHES),
    "performance_kept": (performance_kept, sql_rates("campaign_id", "message_id", SQL_KNOWN, SQL_TOTALS)),
    "incremental_ingest": (incremental_ingest, INCREMENTAL_INGEST),
    "jobs_performance": (
        jobs_performance,
        sql_rates("campaign_id", "message_id", SQL_KNOWN, SQL_TOTALS),
    ),
    "jobs_export_performance": (
        jobs_export_performance,
        sql_rates("campaign_id", "message_id", SQL_KNOWN, SQL_TOTALS),
    ),
    "jobs_export_holidays": (jobs_export_holidays, JOBS_EXPORT_HOLIDAYS),
    "jobs_validation": (jobs_validation, _jobs_validation_sql()),
}
