"""Compare the registered queries with their SQL: ``python tests/oracle.py SF_DIR [names]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations""".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value: object) -> str:
    if value is None:
        return "~"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if the DataFrame and the SQL give the same columns and rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got = _canonical(df.columns, [tuple(r) for r in df.collect()])
    want = _canonical(names, result.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main(sf_dir: str, *only: str) -> int:
    import __spark_entry__ as registered

    from tidemark.session import local_session

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = registered.oracle_sql()
    failed = 0
    for name, query in registered.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            outcome = difference(df, con, sql[name]) if name in sql else f"no SQL, {df.count()} rows"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        bad = outcome is not None and not outcome.startswith("no SQL")
        failed += bad
        print(f"{'FAIL' if bad else 'ok':5}{time.time() - start:6.1f}s {name} {outcome or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]) > 0)
