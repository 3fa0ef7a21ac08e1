"""Filters, projections, casts, nulls, duplicates, unions and slices."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import (
    add_columns,
    add_date_parts,
    add_weekday_name,
    cast_columns,
    columns_of_kind,
    drop_columns,
    drop_duplicates,
    drop_nulls,
    fill_nulls,
    first_rows,
    keep_columns,
    number_rows,
    rename_columns,
    slice_rows,
    union_rows,
    where,
)
from tidemark.sources import read_parquet

from .tables import SQL_TIMESTAMP_TEXT, longs, sql_text, table, text


def filter_expr(spark, sf):
    rows = where(table(spark, sf, "lineitem"), "l_quantity > 25 AND (l_returnflag = 'R' OR l_discount >= 0.05)")
    return rows.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_discount")


FILTER_EXPR = """
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_discount FROM lineitem
WHERE l_quantity > 25 AND (l_returnflag = 'R' OR l_discount >= 0.05)"""


def filter_unknown(spark, sf):
    """A condition that is null for some rows drops them."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.expr("nullif(o_orderstatus, 'P') AS status"))
    return where(orders, F.col("status") != "F")


FILTER_UNKNOWN = """
SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders
WHERE nullif(o_orderstatus, 'P') <> 'F'"""


def rename_swap(spark, sf):
    swapped = {"c_name": "c_mktsegment", "c_mktsegment": "c_name", "c_custkey": "id"}
    return rename_columns(table(spark, sf, "customer"), swapped)


RENAME_SWAP = """
SELECT c_custkey AS id, c_name AS c_mktsegment, c_nationkey, c_acctbal, c_mktsegment AS c_name
FROM customer"""


def drop_columns_query(spark, sf):
    return drop_columns(table(spark, sf, "part"), ["p_type", "p_brand"])


DROP_COLUMNS = "SELECT p_partkey, p_name, p_size, p_retailprice FROM part"


def scan_columns(spark, sf):
    return read_parquet(spark, f"{sf}/lineitem.parquet", columns=["l_suppkey", "l_tax"])


SCAN_COLUMNS = "SELECT l_suppkey, l_tax FROM lineitem"


def derived_columns(spark, sf):
    rows = add_columns(
        table(spark, sf, "lineitem"),
        {
            "net_price": "l_extendedprice * (1 - l_discount)",
            "is_returned": F.col("l_returnflag") == "R",
            "size_class": "CASE WHEN l_quantity > 40 THEN 'large' WHEN l_quantity > 10 THEN 'medium' ELSE 'small' END",
        },
    )
    return rows.select("l_orderkey", "l_linenumber", F.round("net_price", 4).alias("net_price"), "is_returned", "size_class")


DERIVED_COLUMNS = """
SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net_price,
       l_returnflag = 'R' AS is_returned,
       CASE WHEN l_quantity > 40 THEN 'large' WHEN l_quantity > 10 THEN 'medium' ELSE 'small' END AS size_class
FROM lineitem"""


def cast_types(spark, sf):
    texts = table(spark, sf, "events").select(
        "event_id",
        F.regexp_extract("props", r"(\d+)", 1).alias("k"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string")).alias("amount"),
        F.when(F.col("event_type") == "view", "?").otherwise(F.col("user_id").cast("string")).alias("user"),
        F.col("user_id").alias("user_text"),
        F.col("event_type").alias("category"),
    )
    types = {"k": "int", "amount": "float", "user": "int", "user_text": "str", "category": "category"}
    return cast_columns(texts, types)


CAST_TYPES = """
SELECT event_id, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k,
       CASE WHEN event_type = 'error' THEN NULL ELSE value END AS amount,
       CASE WHEN event_type = 'view' THEN NULL ELSE user_id END AS "user",
       CAST(user_id AS VARCHAR) AS user_text, event_type AS category
FROM events"""

_WORDS = """CASE event_type WHEN 'view' THEN 'T' WHEN 'click' THEN 'Verdadero' WHEN 'purchase' THEN 'no'
       WHEN 'signup' THEN ' t' ELSE NULL END"""


def cast_bool_words(spark, sf):
    words = table(spark, sf, "events").select(
        "event_id",
        F.expr(_WORDS).alias("word"),
        F.expr(_WORDS).alias("flag"),
        F.expr("CAST(value > 250 AS INT)").alias("digit"),
    )
    return cast_columns(words, {"flag": "bool", "digit": "bool"})


CAST_BOOL_WORDS = f"""
SELECT event_id, word, CASE WHEN word IN ('T', 'Verdadero') THEN true WHEN word = 'no' THEN false END AS flag,
       value > 250 AS digit
FROM (SELECT event_id, value, {_WORDS} AS word FROM events)"""


def parse_timestamp_query(spark, sf):
    """One text form per event type; errors carry no date, purchases no time of day."""
    ts = F.col("ts")
    written = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "view", ts.cast("string"))
        .when(F.col("event_type") == "click", F.date_format(ts, "yyyy/MM/dd'T'HH:mm:ss"))
        .when(F.col("event_type") == "signup", F.date_format(ts, "dd/MM/yyyy HH:mm"))
        .when(F.col("event_type") == "purchase", F.date_format(ts, "yyyy-MM-dd"))
        .otherwise("31/02/2024")
        .alias("ts"),
    )
    return cast_columns(written, {"ts": "timestamp"}).select("event_id", text("ts"))


PARSE_TIMESTAMP = f"""
SELECT event_id, strftime(CASE event_type WHEN 'view' THEN ts WHEN 'click' THEN date_trunc('second', ts)
       WHEN 'signup' THEN date_trunc('minute', ts)
       WHEN 'purchase' THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) END, '{SQL_TIMESTAMP_TEXT}') AS ts
FROM events"""


def _orders_with_nulls(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.expr("nullif(o_orderstatus, 'P') AS status"),
        F.expr("nullif(o_orderpriority, '1-URGENT') AS priority"),
        F.expr("CASE WHEN o_totalprice > 250000 THEN NULL ELSE o_totalprice END AS price"),
        F.expr("CASE WHEN o_orderstatus = 'O' THEN CAST('NaN' AS DOUBLE) ELSE 1.5 END AS weight"),
    )


_SQL_ORDERS_WITH_NULLS = """
(SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, nullif(o_orderpriority, '1-URGENT') AS priority,
        CASE WHEN o_totalprice > 250000 THEN NULL ELSE o_totalprice END AS price, o_orderstatus
 FROM orders)"""


def drop_nulls_query(spark, sf):
    """NaN is a value: no row is dropped for it."""
    kept = drop_nulls(_orders_with_nulls(spark, sf), ["status", "weight"])
    return kept.select("o_orderkey", "status", "priority", "price", F.isnan("weight").alias("weight_is_nan"))


DROP_NULLS = f"""
SELECT o_orderkey, status, priority, price, o_orderstatus = 'O' AS weight_is_nan
FROM {_SQL_ORDERS_WITH_NULLS} WHERE status IS NOT NULL"""


def drop_nulls_any(spark, sf):
    return drop_nulls(_orders_with_nulls(spark, sf).drop("weight"), any_column=True)


DROP_NULLS_ANY = f"""
SELECT o_orderkey, status, priority, price FROM {_SQL_ORDERS_WITH_NULLS}
WHERE status IS NOT NULL AND priority IS NOT NULL AND price IS NOT NULL"""


def drop_then_fill(spark, sf):
    filled = drop_nulls(
        _orders_with_nulls(spark, sf).drop("weight"), ["status"], fill={"priority": "unknow", "price": 0.0}
    )
    return filled


DROP_THEN_FILL = f"""
SELECT o_orderkey, status, coalesce(priority, 'unknow') AS priority, coalesce(price, 0) AS price
FROM {_SQL_ORDERS_WITH_NULLS} WHERE status IS NOT NULL"""


def fill_nulls_query(spark, sf):
    filled = fill_nulls(_orders_with_nulls(spark, sf), {"status": "?", "weight": 0.0, "price": -1})
    return filled.select("o_orderkey", "status", "priority", "price", F.isnan("weight").alias("weight_is_nan"))


FILL_NULLS = f"""
SELECT o_orderkey, coalesce(status, '?') AS status, priority, coalesce(price, -1) AS price,
       o_orderstatus = 'O' AS weight_is_nan
FROM {_SQL_ORDERS_WITH_NULLS}"""


def dedup_first(spark, sf):
    rows = drop_duplicates(table(spark, sf, "events"), ["user_id"], order_by=["ts", "event_id"])
    return rows.select("user_id", "event_id", "event_type", "value", text("ts"))


DEDUP_FIRST = f"""
SELECT user_id, event_id, event_type, value, {sql_text('ts')}
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1"""


def dedup_first_in_file(spark, sf):
    """The first row of each key as the file holds them (ids are written in order)."""
    events = read_parquet(
        spark, f"{sf}/events.parquet", columns=["event_id", "event_type", "user_id"], position="place"
    )
    kept = drop_duplicates(events, ["user_id", "event_type"], order_by=["place"])
    # The table is one file, so the index of a row in its file is its place.
    return kept.withColumn("place", F.col("place.row_index"))


DEDUP_FIRST_IN_FILE = """
SELECT event_id, event_type, user_id, place
FROM (SELECT event_id, event_type, user_id, row_number() OVER (ORDER BY event_id) - 1 AS place,
             row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events)
WHERE rn = 1"""


def dedup_rows(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_suppkey", F.expr("nullif(l_returnflag, 'N') AS flag"), "l_linestatus", "l_linenumber"
    )
    return drop_duplicates(rows)


DEDUP_ROWS = """
SELECT DISTINCT l_suppkey, nullif(l_returnflag, 'N') AS flag, l_linestatus, l_linenumber FROM lineitem"""


def union_rows_query(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return union_rows(
        where(orders, "o_orderstatus = 'F'"), where(orders, "o_totalprice > 200000"), where(orders, "o_orderstatus = 'P'")
    )


UNION_ROWS = """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice > 200000
UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'P'"""


def slice_rows_query(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return slice_rows(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")], offset=500, length=1000)


SLICE_ROWS = """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000 OFFSET 500"""


def slice_rows_far(spark, sf):
    """The same slice cut out of the numbered table, as far slices are."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return slice_rows(
        orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")], offset=500, length=1000
    )


def number_rows_query(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return number_rows(orders, ["o_totalprice", "o_orderkey"])


NUMBER_ROWS = """
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS row_number
FROM orders"""


def chunk_rows(spark, sf):
    """The second chunk of 5,000 rows of a file, in file order (keys are written in order)."""
    return read_parquet(spark, f"{sf}/orders.parquet", columns=["o_orderkey", "o_custkey"], chunk=(1, 5000))


CHUNK_ROWS = "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5000 OFFSET 5000"


def first_rows_query(spark, sf):
    return first_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey"), 5)


FIRST_ROWS = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5"


def columns_by_kind(spark, sf):
    lineitem = table(spark, sf, "lineitem")
    return keep_columns(lineitem, columns_of_kind(lineitem, "text") + columns_of_kind(lineitem, "numeric"))


COLUMNS_BY_KIND = """
SELECT l_returnflag, l_linestatus, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
       l_extendedprice, l_discount, l_tax FROM lineitem"""


def date_parts(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    parts = add_date_parts(orders, "o_orderdate").select("o_orderkey", "day", "month", "year")
    return longs(parts, "day", "month", "year")


DATE_PARTS = """
SELECT o_orderkey, day(o_orderdate) AS day, month(o_orderdate) AS month, year(o_orderdate) AS year FROM orders"""


def weekday_name(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    named = add_weekday_name(orders, "o_orderdate")
    return add_weekday_name(named, "o_orderdate", "shifted", compat_shift=True).drop("o_orderdate")


WEEKDAY_NAME = """
SELECT o_orderkey,
       (['Lunes', 'Martes', 'Miercoles', 'Jueves', 'Viernes', 'Sabado', 'Domingo'])[isodow(o_orderdate)] AS weekday,
       (['Martes', 'Miercoles', 'Jueves', 'Viernes', 'Sabado', 'Domingo', NULL])[isodow(o_orderdate)] AS shifted
FROM orders"""

QUERIES = {
    "filter_expr": (filter_expr, FILTER_EXPR),
    "filter_unknown": (filter_unknown, FILTER_UNKNOWN),
    "rename_swap": (rename_swap, RENAME_SWAP),
    "drop_columns": (drop_columns_query, DROP_COLUMNS),
    "scan_columns": (scan_columns, SCAN_COLUMNS),
    "derived_columns": (derived_columns, DERIVED_COLUMNS),
    "cast_types": (cast_types, CAST_TYPES),
    "cast_bool_words": (cast_bool_words, CAST_BOOL_WORDS),
    "parse_timestamp": (parse_timestamp_query, PARSE_TIMESTAMP),
    "drop_nulls": (drop_nulls_query, DROP_NULLS),
    "drop_nulls_any": (drop_nulls_any, DROP_NULLS_ANY),
    "drop_then_fill": (drop_then_fill, DROP_THEN_FILL),
    "fill_nulls": (fill_nulls_query, FILL_NULLS),
    "dedup_first": (dedup_first, DEDUP_FIRST),
    "dedup_first_in_file": (dedup_first_in_file, DEDUP_FIRST_IN_FILE),
    "dedup_rows": (dedup_rows, DEDUP_ROWS),
    "union_rows": (union_rows_query, UNION_ROWS),
    "slice_rows": (slice_rows_query, SLICE_ROWS),
    "slice_rows_far": (slice_rows_far, SLICE_ROWS),
    "number_rows": (number_rows_query, NUMBER_ROWS),
    "chunk_rows": (chunk_rows, CHUNK_ROWS),
    "first_rows": (first_rows_query, FIRST_ROWS),
    "columns_by_kind": (columns_by_kind, COLUMNS_BY_KIND),
    "date_parts": (date_parts, DATE_PARTS),
    "weekday_name": (weekday_name, WEEKDAY_NAME),
}
