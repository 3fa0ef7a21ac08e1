"""Database tables and queries over JDBC."""

from __future__ import annotations

import datetime
import decimal
import re

from pyspark.sql import DataFrame, SparkSession

# A quoted text or name, a cast (::type), or a :name parameter.
_TOKENS = re.compile(r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|::|:([A-Za-z_]\w*)")


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float, decimal.Decimal)):
        return str(value)
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        if "\\" in value or "\x00" in value:
            raise ValueError("text parameters must not hold backslashes or NUL, databases read them differently")
        return "'" + value.replace("'", "''") + "'"
    raise TypeError(f"cannot bind a {type(value).__name__}")


def bind(query: str, params: dict[str, object] | None = None) -> str:
    """The query with its ``:name`` parameters as SQL literals.

    Spark's JDBC source takes no bound parameters. Quoted text is left alone.
    """
    params = params or {}

    def replace(match: re.Match) -> str:
        name = match.group(1)
        if name is None:
            return match.group(0)
        if name not in params:
            raise ValueError(f"no value for parameter :{name}")
        return _literal(params[name])

    return _TOKENS.sub(replace, query)


def read_options(
    url: str,
    query: str | None = None,
    table: str | None = None,
    params: dict[str, object] | None = None,
    partition: tuple[str, object, object, int] | None = None,
    fetchsize: int = 10_000,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of Spark's JDBC reader for a query or a table."""
    if bool(query) == bool(table):
        raise ValueError("give either a query or a table")
    options = {"url": url, "fetchsize": str(fetchsize), **(properties or {})}
    if partition is None:
        options["query" if query else "dbtable"] = bind(query, params) if query else table
        return options
    column, lower, upper, count = partition
    options["dbtable"] = f"({bind(query, params)}) t" if query else table
    options |= {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(count),
    }
    return options


def read_jdbc(spark: SparkSession, url: str, **options) -> DataFrame:
    """Read a query (with ``params``) or a table.

    Without ``partition=(column, lower, upper, count)`` the result comes through one
    connection in one task: give it for anything large. Rows outside the bounds are
    read too, by the first and the last partition.
    """
    return spark.read.format("jdbc").options(**read_options(url, **options)).load()
