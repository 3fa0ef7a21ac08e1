"""Tables from files, landed JSON records, paged web APIs and databases."""

from .files import infer_schema, read_csv, read_parquet
from .jdbc import bind, read_jdbc
from .records import as_table, read_json_records
from .web import PagedRecords, ingest_api, read_api

__all__ = [
    "PagedRecords",
    "as_table",
    "bind",
    "infer_schema",
    "ingest_api",
    "read_api",
    "read_csv",
    "read_jdbc",
    "read_json_records",
    "read_parquet",
]
