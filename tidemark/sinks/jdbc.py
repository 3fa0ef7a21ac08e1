"""Loading tables into a database over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..naming import ref, require_columns


def write_options(
    url: str,
    table: str,
    batchsize: int = 10_000,
    connections: int = 16,
    truncate: bool = False,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of Spark's JDBC writer."""
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batchsize),
        "numPartitions": str(connections),
        "truncate": str(truncate).lower(),
        **(properties or {}),
    }


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    types: dict[str, str] | None = None,
    mode: str = "append",
    **options,
) -> None:
    """Insert a table with batched statements over at most ``connections`` connections.

    ``types`` converts columns to the target's SQL types. Each task commits on its
    own, so a lost executor may leave a part twice: load into a staging table with
    ``mode="overwrite", truncate=True`` and move the rows on in the database, or
    rely on the target's primary key to refuse the repetition.
    """
    if types:
        require_columns(df, types)
        df = df.withColumns({c: ref(c).cast(kind) for c, kind in types.items()})
    df.write.format("jdbc").options(**write_options(url, table, **options)).mode(mode).save()
