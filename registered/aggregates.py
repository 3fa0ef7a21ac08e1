"""Event totals and rates, and table profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import (
    correlation,
    correlation_matrix,
    count_duplicates,
    describe,
    distinct_counts,
    distinct_estimates,
    distinct_sketches,
    flag_rates,
    keep_referenced,
    merge_sketches,
    null_counts,
    numeric_stats,
)

from .tables import longs, table

_RATE_COLUMNS = """
       round_even(total_opened / nullif(total_sent, 0), 2) AS open_rate,
       CASE WHEN total_opened > 0 THEN round_even(total_clicked / total_opened, 2) ELSE 0 END AS click_rate,
       CASE WHEN total_clicked > 0 THEN round_even(total_purchased / total_clicked, 2) ELSE 0 END AS conversion_rate,
       round_even(total_unsubscribed / nullif(total_sent, 0), 2) AS unsubscribe_rate,
       round_even(total_bounced / nullif(total_sent, 0), 2) AS bounce_rate"""


def sql_rates(key: str, message: str, source: str, flags: dict[str, str]) -> str:
    totals = ", ".join(f"count(*) FILTER ({c}) AS total_{n}" for n, c in flags.items())
    return f"""
SELECT *, {_RATE_COLUMNS}
FROM (SELECT {key}, count({message}) AS total_sent, {totals} FROM {source} GROUP BY {key})"""


_EVENT_FLAGS = {
    "is_opened": "event_type = 'view'",
    "is_clicked": "event_type = 'click'",
    "is_purchased": "event_type = 'purchase'",
    "is_unsubscribed": "event_type = 'signup'",
    "is_hard_bounced": "event_type = 'error' AND value > 50",
    "is_soft_bounced": "event_type = 'error' AND value <= 50",
}


def flag_rates_query(spark, sf):
    flags = [F.expr(c).alias(n) for n, c in _EVENT_FLAGS.items()]
    events = table(spark, sf, "events").select("user_id", "event_id", *flags)
    return flag_rates(events, key="user_id", id_column="event_id")


FLAG_RATES = sql_rates(
    "user_id",
    "event_id",
    "events",
    {
        "opened": "event_type = 'view'",
        "clicked": "event_type = 'click'",
        "purchased": "event_type = 'purchase'",
        "unsubscribed": "event_type = 'signup'",
        "bounced": "event_type = 'error'",
    },
)


def flag_rates_zero_denominator(spark, sf):
    """Groups per key and event type, so that most totals are zero; the ids of errors
    and the key of sign-ups are null, and flags are 0, 1 or null."""
    events = table(spark, sf, "events").select(
        F.expr("CASE WHEN event_type <> 'signup' THEN concat(user_id, event_type) END AS k"),
        F.expr("CASE WHEN event_type <> 'error' THEN event_id END AS id"),
        F.expr("CASE WHEN event_type = 'view' THEN CAST(value > 100 AS INT) END AS is_opened"),
        F.expr("CAST(event_type IN ('view', 'click') AND value > 200 AS INT) AS is_clicked"),
        F.expr("CASE WHEN value > 300 THEN 1 END AS is_purchased"),
        F.expr("CAST(NULL AS INT) AS is_unsubscribed"),
        F.expr("CASE WHEN event_type = 'error' THEN 1 END AS is_hard_bounced"),
        F.expr("CASE WHEN value < 50 THEN 0 END AS is_soft_bounced"),
    )
    return flag_rates(events, key="k", id_column="id")


FLAG_RATES_ZERO_DENOMINATOR = sql_rates(
    "k",
    "id",
    """(SELECT *, CASE WHEN event_type <> 'signup' THEN CAST(user_id AS VARCHAR) || event_type END AS k,
               CASE WHEN event_type <> 'error' THEN event_id END AS id FROM events)""",
    {
        "opened": "event_type = 'view' AND value > 100",
        "clicked": "event_type IN ('view', 'click') AND value > 200",
        "purchased": "value > 300",
        "unsubscribed": "false",
        "bounced": "event_type = 'error'",
    },
)

_LINE_FLAGS = {
    "is_opened": "l_returnflag <> 'N'",
    "is_clicked": "l_returnflag = 'R'",
    "is_purchased": "l_returnflag = 'R' AND l_linestatus = 'F'",
    "is_unsubscribed": "l_linestatus = 'O' AND l_quantity > 45",
    "is_hard_bounced": "l_quantity < 3",
    "is_soft_bounced": "l_discount > 0.09",
}


def flagship(spark, sf):
    """Lines of known parts and suppliers, totalled per supplier."""
    lines = keep_referenced(
        table(spark, sf, "lineitem"),
        [
            ("l_suppkey", table(spark, sf, "supplier").filter("s_acctbal > 0"), "s_suppkey"),
            ("l_partkey", table(spark, sf, "part").filter("p_size > 25"), "p_partkey"),
        ],
        unique_keys=True,
    )
    flags = [F.expr(c).alias(n) for n, c in _LINE_FLAGS.items()]
    return flag_rates(lines.select("l_suppkey", "l_orderkey", *flags), key="l_suppkey", id_column="l_orderkey")


FLAGSHIP = sql_rates(
    "l_suppkey",
    "l_orderkey",
    """(SELECT * FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 25)
        AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0))""",
    {
        "opened": "l_returnflag <> 'N'",
        "clicked": "l_returnflag = 'R'",
        "purchased": "l_returnflag = 'R' AND l_linestatus = 'F'",
        "unsubscribed": "l_linestatus = 'O' AND l_quantity > 45",
        "bounced": "l_quantity < 3 OR l_discount > 0.09",
    },
)

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _rounded(df, names):
    return df.withColumns({n: F.round(n, 6) for n in names})


def profile_stats(spark, sf):
    stats = numeric_stats(table(spark, sf, "lineitem"), _MEASURES)
    return _rounded(stats, stats.columns)


PROFILE_STATS = "SELECT " + ", ".join(
    f"round({f}({c}), 6) AS {c}_{n}"
    for n, f in {"mean": "avg", "min": "min", "max": "max", "std": "stddev_samp"}.items()
    for c in _MEASURES
) + " FROM lineitem"


def profile_nulls(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.expr("nullif(o_orderstatus, 'P') AS status"),
        F.expr("CASE WHEN o_totalprice < 100000 THEN NULL ELSE o_totalprice END AS price"),
    )
    return null_counts(orders)


PROFILE_NULLS = """
SELECT count(*) FILTER (o_orderkey IS NULL) AS o_orderkey, count(*) FILTER (o_orderstatus = 'P') AS status,
       count(*) FILTER (o_totalprice < 100000) AS price FROM orders"""


def profile_duplicates(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", F.expr("CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_linenumber END AS line")
    )
    return count_duplicates(lines)


PROFILE_DUPLICATES = """
SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_rows, CAST(sum(n) - count(*) AS BIGINT) AS duplicates
FROM (SELECT count(*) AS n FROM lineitem
      GROUP BY l_orderkey, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_linenumber END)"""


def profile_duplicate_keys(spark, sf):
    return count_duplicates(table(spark, sf, "orders"), ["o_custkey"])


PROFILE_DUPLICATE_KEYS = """
SELECT count(*) AS rows, count(DISTINCT o_custkey) AS distinct_rows,
       count(*) - count(DISTINCT o_custkey) AS duplicates FROM orders"""


def _distinct_source(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_shipdate",
        F.expr("CASE WHEN l_linenumber < 4 THEN l_suppkey END AS supplier"),
    )


def profile_distinct(spark, sf):
    """Values, nulls and distinct values of six columns of different types."""
    return distinct_counts(_distinct_source(spark, sf))


_DISTINCT_COLUMNS = {c: c for c in ("l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_shipdate")}
_DISTINCT_COLUMNS["supplier"] = "CASE WHEN l_linenumber < 4 THEN l_suppkey END"
PROFILE_DISTINCT = " UNION ALL ".join(
    f"""SELECT '{name}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS "distinct",
        count({c}) - count(DISTINCT {c}) AS repeated FROM lineitem"""
    for name, c in _DISTINCT_COLUMNS.items()
)


def profile_distinct_sketches(spark, sf):
    """Sketches of the parts of a table by flag, merged: whether the estimates are within 4 % of the numbers."""
    source = _distinct_source(spark, sf)
    columns = [c for c in source.columns if c != "l_returnflag"]
    merged = merge_sketches(distinct_sketches(source, columns, by=["l_returnflag"]), columns)
    estimates = distinct_estimates(merged).unpivot([], columns, "column", "estimate")
    exact = distinct_counts(source, columns).select("column", "distinct")
    near = F.abs(F.col("estimate") - F.col("distinct")) <= 0.04 * F.col("distinct")
    return exact.join(estimates, "column").select("column", "distinct", near.alias("near"))


PROFILE_DISTINCT_SKETCHES = " UNION ALL ".join(
    f"""SELECT '{name}' AS "column", count(DISTINCT {c}) AS "distinct", true AS near FROM lineitem"""
    for name, c in _DISTINCT_COLUMNS.items()
    if name != "l_returnflag"
)


def profile_corr(spark, sf):
    pairs = [("l_quantity", "l_extendedprice"), ("l_extendedprice", "discounted")]
    lines = table(spark, sf, "lineitem").withColumn(
        "discounted", F.expr("CASE WHEN l_discount > 0.02 THEN l_extendedprice * (1 - l_discount) END")
    )
    result = correlation(lines, pairs)
    return _rounded(result, result.columns)


PROFILE_CORR = """
SELECT round(corr(l_quantity, l_extendedprice), 6) AS l_quantity_l_extendedprice,
       round(corr(l_extendedprice, CASE WHEN l_discount > 0.02 THEN l_extendedprice * (1 - l_discount) END), 6)
         AS l_extendedprice_discounted FROM lineitem"""


def profile_corr_matrix(spark, sf):
    lines = table(spark, sf, "lineitem").select(*_MEASURES, F.lit(1.0).alias("constant"))
    return _rounded(correlation_matrix(lines), [*_MEASURES, "constant"])


PROFILE_CORR_MATRIX = " UNION ALL ".join(
    f"SELECT '{a}' AS \"column\", "
    + ", ".join("1.0::DOUBLE AS " + b if a == b else f"round(corr({a}, {b}), 6) AS {b}" for b in _MEASURES)
    + ", NULL::DOUBLE AS constant FROM lineitem"
    for a in _MEASURES
) + " UNION ALL SELECT 'constant', NULL, NULL, NULL, NULL, NULL"


def profile_describe(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_custkey", F.expr("CASE WHEN o_totalprice < 100000 THEN NULL ELSE o_totalprice END AS price"), "o_orderstatus"
    )
    summary = describe(orders)
    return _rounded(longs(summary, "orden"), ["o_custkey", "price"])


def _describe_sql() -> str:
    numbers = ["o_custkey", "price"]

    def nearest(share: float) -> str:
        """The value whose 0-based place is the rounded share of the last one's."""
        place = f"CAST(floor((count({{0}}) OVER () - 1) * {share} + 0.5) AS BIGINT) + 1"
        numbered = f"row_number() OVER (ORDER BY {{0}} NULLS LAST) = {place}"
        return f"(SELECT {{0}} FROM (SELECT {{0}}, {numbered} AS hit FROM {source}) WHERE hit)"

    source = "(SELECT *, CASE WHEN o_totalprice < 100000 THEN NULL ELSE o_totalprice END AS price FROM orders)"
    statistics = [
        ("count", "count({0})", "CAST(count(o_orderstatus) AS VARCHAR)"),
        ("null_count", "count(*) - count({0})", "CAST(count(*) - count(o_orderstatus) AS VARCHAR)"),
        ("mean", "round(avg({0}), 6)", "NULL"),
        ("std", "round(stddev_samp({0}), 6)", "NULL"),
        ("min", "min({0})", "min(o_orderstatus)"),
        *[(f"{p}%", nearest(p / 100), "NULL") for p in (25, 50, 75)],
        ("max", "max({0})", "max(o_orderstatus)"),
    ]
    rows = []
    for i, (name, number, word) in enumerate(statistics):
        cells = ", ".join(f"CAST({number.format(c)} AS DOUBLE) AS {c}" for c in numbers)
        origin = "" if name.endswith("%") else f" FROM {source}"
        rows.append(
            f"SELECT {i}::BIGINT AS orden, '{name}' AS statistic, {cells}, {word}::VARCHAR AS o_orderstatus{origin}"
        )
    return " UNION ALL ".join(rows)


QUERIES = {
    "flagship": (flagship, FLAGSHIP),
    "flag_rates": (flag_rates_query, FLAG_RATES),
    "flag_rates_zero_denominator": (flag_rates_zero_denominator, FLAG_RATES_ZERO_DENOMINATOR),
    "profile_stats": (profile_stats, PROFILE_STATS),
    "profile_nulls": (profile_nulls, PROFILE_NULLS),
    "profile_duplicates": (profile_duplicates, PROFILE_DUPLICATES),
    "profile_duplicate_keys": (profile_duplicate_keys, PROFILE_DUPLICATE_KEYS),
    "profile_distinct": (profile_distinct, PROFILE_DISTINCT),
    "profile_distinct_sketches": (profile_distinct_sketches, PROFILE_DISTINCT_SKETCHES),
    "profile_corr": (profile_corr, PROFILE_CORR),
    "profile_corr_matrix": (profile_corr_matrix, PROFILE_CORR_MATRIX),
    "profile_describe": (profile_describe, _describe_sql()),
}
