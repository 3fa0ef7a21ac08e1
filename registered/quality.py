"""Data-quality reports."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tidemark import plans
from tidemark.operators import keep_columns, quality_report

from . import raw
from .tables import longs, table


# --- Fixed values: rule names and detail texts of the reports, here and in the SQL below ---


def sql_report(source: str, rules: list[tuple[str, str, str, str]]) -> str:
    """``rules``: column, rule, failed condition, detail; over one pass of ``source``."""
    rows = []
    for i, (column, rule, failed, detail) in enumerate(rules):
        # A rule decided by the schema reads no rows.
        rows.append(
            f"SELECT {i}::BIGINT AS orden, '{column}' AS columna, '{rule}' AS regla, "
            f"CASE WHEN {failed} THEN 'FALLA' ELSE 'OK' END AS estado, {detail} AS detalle"
            + ("" if failed in ("true", "false") else f" FROM {source}")
        )
    rows.append(
        f"SELECT {len(rules)}::BIGINT, 'Total Registros', '', '', count(*) || ' de registros' FROM {source}"
    )
    return " UNION ALL ".join(rows)


def sql_counter(column: str, rule: str, counter: str, words: str) -> tuple[str, str, str, str]:
    return column, rule, f"{counter} > 0", f"{counter} || ' {words}'"


def sql_fixed(column: str, rule: str, failed: bool, detail: str) -> tuple[str, str, str, str]:
    return column, rule, str(failed).lower(), "'" + detail.replace("'", "''") + "'"


def sql_null_share(column: str) -> tuple[str, str, str, str]:
    share = f"count(*) FILTER ({column} IS NULL)::DOUBLE / count(*) * 100"
    return column, "nulos_mayor_95", f"{share} > 95", f"printf('%.2f%% de nulos en la columna', {share})"


def quality_report_query(spark, sf):
    rules = [
        ("o_orderkey", "no_nulos"),
        ("o_orderkey", "no_duplicados"),
        ("o_custkey", "no_duplicados"),
        ("o_totalprice", "valores_positivos"),
        ("o_orderdate", "formato_fecha"),
        ("o_orderdate", "fecha_no_futura"),
        ("o_orderstatus", "validacion_boolean"),
        ("o_orderkey", "formato_fecha"),
        ("o_comment", "no_nulos"),
        ("o_orderkey", "sin_ceros"),
    ]
    return longs(quality_report(table(spark, sf, "orders"), rules, as_of=datetime.date(2000, 6, 30)), "orden")


QUALITY_REPORT = sql_report(
    "orders",
    [
        sql_counter("o_orderkey", "no_nulos", "count(*) FILTER (o_orderkey IS NULL)", "valores nulos"),
        sql_counter("o_orderkey", "no_duplicados", "(count(*) - count(DISTINCT o_orderkey))", "duplicados encontrados"),
        sql_counter("o_custkey", "no_duplicados", "(count(*) - count(DISTINCT o_custkey))", "duplicados encontrados"),
        sql_counter("o_totalprice", "valores_positivos", "count(*) FILTER (o_totalprice < 0)", "valores negativos"),
        sql_fixed("o_orderdate", "formato_fecha", False, "Columna 'o_orderdate' ya es tipo timestamp_ntz"),
        sql_counter(
            "o_orderdate",
            "fecha_no_futura",
            "count(*) FILTER (CAST(o_orderdate AS DATE) > DATE '2000-06-30')",
            "registros con fecha futura",
        ),
        sql_fixed("o_orderstatus", "validacion_boolean", True, "Valores no corresponden a booleanos"),
        sql_fixed("o_orderkey", "formato_fecha", False, "Columna 'o_orderkey' convertida desde timestamp numérico"),
        sql_fixed("o_comment", "no_nulos", True, "Columna no encontrada"),
        sql_fixed("o_orderkey", "sin_ceros", True, "Regla 'sin_ceros' no reconocida"),
    ],
)


def _customers(spark, sf):
    """Customers with missing, repeated and malformed values."""
    return table(spark, sf, "customer").selectExpr(
        "CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_custkey END AS id",
        """CASE c_mktsegment WHEN 'BUILDING' THEN concat('josé.', c_custkey, '@x.co') WHEN 'MACHINERY' THEN 'a@b'
           WHEN 'HOUSEHOLD' THEN NULL ELSE concat('c-', c_custkey, '@mail.example.org') END AS email""",
        "CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_nationkey + 10 END AS age",
        "c_acctbal AS balance",
        "CASE WHEN c_nationkey = 3 THEN 'x' END AS rare",
        "c_acctbal > 0 AS active",
        """CASE c_mktsegment WHEN 'BUILDING' THEN '2024-05-06 07:08:09' WHEN 'MACHINERY' THEN '2024-05-06'
           WHEN 'HOUSEHOLD' THEN NULL WHEN 'FURNITURE' THEN '2024-13-01' ELSE '6 May' END AS since""",
        "CASE WHEN c_nationkey < 9 THEN c_nationkey END AS nation",
        "CASE WHEN c_nationkey <> 4 THEN 1704067200 + c_nationkey * 40000 - 400000 END AS seen",
    )


_CUSTOMER_RULES = [
    ("id", "no_nulos"),
    ("id", "no_duplicados"),
    ("nation", "no_duplicados"),
    ("email", "formato_email"),
    ("age", "edad_mayor_18"),
    ("balance", "valores_positivos"),
    ("rare", "nulos_mayor_95"),
    ("email", "nulos_mayor_95"),
    ("active", "validacion_boolean"),
    ("since", "formato_fecha"),
    ("since", "fecha_no_futura"),
    ("active", "formato_fecha"),
    ("seen", "formato_fecha"),
    ("seen", "fecha_no_futura"),
]


def quality_report_nulls(spark, sf):
    report = quality_report(_customers(spark, sf), _CUSTOMER_RULES, as_of=datetime.date(2024, 1, 1))
    return longs(report, "orden")


def quality_report_compat(spark, sf):
    """Any text passes as a date."""
    report = quality_report(
        _customers(spark, sf), _CUSTOMER_RULES, as_of=datetime.date(2024, 1, 1), compat_dates=True
    )
    return longs(report, "orden")


_SQL_CUSTOMERS = """(SELECT *, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_custkey END AS id,
    CASE WHEN c_nationkey < 9 THEN c_nationkey END AS nation,
    CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'x' END AS email,
    CASE WHEN c_nationkey = 3 THEN 'x' END AS rare FROM customer)"""


def _customer_report(date_rule: tuple[str, str, str, str]) -> str:
    return sql_report(
        _SQL_CUSTOMERS,
        [
            sql_counter("id", "no_nulos", "count(*) FILTER (id IS NULL)", "valores nulos"),
            sql_counter(
                "id",
                "no_duplicados",
                "(count(*) - count(DISTINCT id) - max(CASE WHEN id IS NULL THEN 1 ELSE 0 END))",
                "duplicados encontrados",
            ),
            sql_counter(
                "nation",
                "no_duplicados",
                "(count(*) - count(DISTINCT nation) - max(CASE WHEN nation IS NULL THEN 1 ELSE 0 END))",
                "duplicados encontrados",
            ),
            sql_counter("email", "formato_email", "count(*) FILTER (c_mktsegment = 'MACHINERY')", "correos inválidos"),
            sql_counter(
                "age",
                "edad_mayor_18",
                "count(*) FILTER (c_mktsegment <> 'FURNITURE' AND c_nationkey + 10 < 18)",
                "registros con edad menor a 18",
            ),
            sql_counter("balance", "valores_positivos", "count(*) FILTER (c_acctbal < 0)", "valores negativos"),
            sql_null_share("rare"),
            sql_null_share("email"),
            sql_fixed("active", "validacion_boolean", False, "Columna 'active' es tipo booleano."),
            date_rule,
            sql_counter(
                "since",
                "fecha_no_futura",
                "count(*) FILTER (c_mktsegment = 'BUILDING')",
                "registros con fecha futura",
            ),
            sql_fixed("active", "formato_fecha", True, "Tipo no compatible para fecha: boolean"),
            sql_fixed("seen", "formato_fecha", False, "Columna 'seen' convertida desde timestamp numérico"),
            sql_counter(
                "seen",
                "fecha_no_futura",
                "count(*) FILTER (c_nationkey <> 4 AND 1704067200 + c_nationkey * 40000 - 400000 >= 1704153600)",
                "registros con fecha futura",
            ),
        ],
    )


QUALITY_REPORT_NULLS = _customer_report(
    sql_counter(
        "since", "formato_fecha", "count(*) FILTER (c_mktsegment NOT IN ('BUILDING', 'HOUSEHOLD'))", "fechas no reconocidas"
    )
)
QUALITY_REPORT_COMPAT = _customer_report(
    sql_fixed("since", "formato_fecha", False, "Columna 'since' convertida desde string")
)


# Bounds that leave null shares halfway between two decimals where the table has 60,000 rows.
_BOUNDS = [0, 3, 7, 11, 15, 39, 46, 70, 96, 135]


def null_share_ties(spark, sf):
    """Null shares whose second decimal hangs on the exact value of the share."""
    missing = [f"CASE WHEN l_orderkey > {b} THEN l_partkey END AS over_{b}" for b in _BOUNDS]
    report = quality_report(table(spark, sf, "lineitem").selectExpr(*missing), [(f"over_{b}", "nulos_mayor_95") for b in _BOUNDS])
    return longs(report, "orden")


NULL_SHARE_TIES = sql_report(
    "(SELECT " + ", ".join(f"CASE WHEN l_orderkey > {b} THEN l_partkey END AS over_{b}" for b in _BOUNDS) + " FROM lineitem)",
    [sql_null_share(f"over_{b}") for b in _BOUNDS],
)


def validate_clients(spark, sf):
    """The rules of the enriched clients, on the table itself."""
    clients = plans.enriched_clients(
        plans.clean_clients(raw.raw_clients(spark, sf)), plans.clean_customer_records(raw.customer_records(spark, sf))
    )
    report = longs(quality_report(clients, plans.CLIENT_RULES), "orden")
    return keep_columns(report, ["orden", "columna", "regla", "estado", "detalle"])


SQL_CLIENT_ROWS = f"""(SELECT c.client_id, coalesce(r.age, 18) AS age,
    coalesce(r.average_purchase_value, 0) AS average_purchase_value
    FROM {raw.SQL_CLIENTS} c LEFT JOIN {raw.SQL_RECORDS} r ON c.client_id = r.id)"""
VALIDATE_CLIENTS = sql_report(
    SQL_CLIENT_ROWS,
    [
        sql_counter("client_id", "no_nulos", "count(*) FILTER (client_id IS NULL)", "valores nulos"),
        sql_counter("age", "edad_mayor_18", "count(*) FILTER (age < 18)", "registros con edad menor a 18"),
        sql_counter(
            "average_purchase_value",
            "valores_positivos",
            "count(*) FILTER (average_purchase_value < 0)",
            "valores negativos",
        ),
        sql_fixed("first_purchase_date", "formato_fecha", False, "Columna 'first_purchase_date' ya es tipo timestamp_ntz"),
    ],
)

QUERIES = {
    "quality_report": (quality_report_query, QUALITY_REPORT),
    "quality_report_nulls": (quality_report_nulls, QUALITY_REPORT_NULLS),
    "quality_report_compat": (quality_report_compat, QUALITY_REPORT_COMPAT),
    "null_share_ties": (null_share_ties, NULL_SHARE_TIES),
    "validate_clients": (validate_clients, VALIDATE_CLIENTS),
}
