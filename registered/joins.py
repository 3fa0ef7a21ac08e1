"""Equi-joins, reference filters and membership flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import count_referenced, flag_membership, keep_referenced, merge, rename_columns

from .tables import table


def _orders(spark, sf):
    """Orders; those of the lowest priority have no customer key."""
    return table(spark, sf, "orders").select(
        "o_orderkey", F.expr("CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS o_custkey"), "o_totalprice"
    )


# Most customers get a key that no order has.
_BUILDER_KEY = "CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey ELSE c_custkey + 10000000 END"
_SPENDER_KEY = "CASE WHEN o_orderstatus = 'P' THEN o_custkey ELSE o_custkey + 40000000 END"


def _builders(spark, sf):
    return table(spark, sf, "customer").selectExpr(f"{_BUILDER_KEY} AS c_custkey", "c_name", "c_acctbal")


_SQL_ORDERS = """(SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS o_custkey,
        o_totalprice FROM orders) o"""
_SQL_BUILDERS = f"(SELECT {_BUILDER_KEY} AS c_custkey, c_name, c_acctbal FROM customer) c"


def _joined(how, unique=None):
    def query(spark, sf):
        return merge(
            _orders(spark, sf), _builders(spark, sf), left_on="o_custkey", right_on="c_custkey", how=how, unique=unique
        )

    return query


_SQL_INNER = f"""
SELECT o_orderkey, o_custkey, o_totalprice, c_name, c_acctbal
FROM {_SQL_ORDERS} JOIN {_SQL_BUILDERS} ON o_custkey = c_custkey"""
_SQL_LEFT = _SQL_INNER.replace(" JOIN ", " LEFT JOIN ")
_SQL_RIGHT = f"""
SELECT o_orderkey, o_totalprice, c_custkey, c_name, c_acctbal
FROM {_SQL_ORDERS} RIGHT JOIN {_SQL_BUILDERS} ON o_custkey = c_custkey"""
_SQL_FULL = f"""
SELECT o_orderkey, o_custkey, o_totalprice, c_custkey, c_name, c_acctbal
FROM {_SQL_ORDERS} FULL JOIN {_SQL_BUILDERS} ON o_custkey = c_custkey"""
_SQL_SEMI = f"SELECT * FROM {_SQL_ORDERS} WHERE EXISTS (SELECT 1 FROM {_SQL_BUILDERS} WHERE o_custkey = c_custkey)"
_SQL_ANTI = _SQL_SEMI.replace("EXISTS", "NOT EXISTS")


def merge_clash(spark, sf):
    """One key name on both sides; the other common name gets a suffix."""
    suppliers = rename_columns(
        table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_name"), {"s_nationkey": "nation", "s_name": "name"}
    )
    nations = rename_columns(table(spark, sf, "nation"), {"n_nationkey": "nation", "n_name": "name"})
    return merge(suppliers, nations, on="nation")


MERGE_CLASH = """
SELECT s_suppkey, s_nationkey AS nation, s_name AS name, n_name AS name_right, n_regionkey
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


def merge_full_same_key(spark, sf):
    """A full join on one key name keeps both keys."""
    spent = table(spark, sf, "orders").groupBy(F.expr(_SPENDER_KEY).alias("id")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    customers = _builders(spark, sf).select(F.col("c_custkey").alias("id"), "c_name")
    return merge(spent, customers, on="id", how="outer")


MERGE_FULL_SAME_KEY = f"""
SELECT o.id, o.orders, c.c_custkey AS id_right, c.c_name
FROM (SELECT {_SPENDER_KEY} AS id, count(*) AS orders FROM orders GROUP BY 1) o
FULL JOIN {_SQL_BUILDERS} ON o.id = c.c_custkey"""


def merge_two_keys(spark, sf):
    orders = table(spark, sf, "orders")
    usual = orders.groupBy("o_custkey", "o_orderpriority").agg(F.max("o_totalprice").alias("largest"))
    return merge(
        orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"),
        usual,
        on=["o_custkey", "o_orderpriority"],
        how="left",
        unique="right",
    )


MERGE_TWO_KEYS = """
SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice,
       max(o_totalprice) OVER (PARTITION BY o_custkey, o_orderpriority) AS largest
FROM orders"""


def _references(spark, sf):
    return [
        ("l_partkey", table(spark, sf, "part").filter("p_size > 25"), "p_partkey"),
        ("l_suppkey", table(spark, sf, "supplier").filter("s_acctbal > 0"), "s_suppkey"),
    ]


def keep_referenced_query(spark, sf):
    lineitem = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return keep_referenced(lineitem, _references(spark, sf))


KEEP_REFERENCED = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 25)
  AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)"""


def count_referenced_query(spark, sf):
    return count_referenced(table(spark, sf, "orders"), "o_custkey", _builders(spark, sf), "c_custkey")


COUNT_REFERENCED = f"""
SELECT count(*) AS rows FROM orders WHERE o_custkey IN (SELECT c_custkey FROM {_SQL_BUILDERS})"""


def _month_ends(spark, sf):
    """Order dates on a 25th, and a null."""
    return table(spark, sf, "orders").select(
        F.expr("CASE WHEN dayofmonth(o_orderdate) = 25 THEN o_orderdate END AS holiday")
    )


_SQL_MONTH_ENDS = "(SELECT CAST(o_orderdate AS DATE) FROM orders WHERE day(o_orderdate) = 25)"


def _membership(broadcast_rows):
    def query(spark, sf):
        lines = table(spark, sf, "lineitem").select(
            "l_orderkey",
            "l_linenumber",
            "l_shipdate",
            F.expr("CASE WHEN l_returnflag = 'N' THEN NULL ELSE date_add(l_shipdate, 1) END AS arrival"),
        )
        options = {} if broadcast_rows is None else {"broadcast_rows": broadcast_rows}
        flagged = flag_membership(lines, ["l_shipdate", "arrival"], _month_ends(spark, sf), "holiday", **options)
        return flagged.drop("l_shipdate", "arrival")

    return query


FLAG_MEMBERSHIP = f"""
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) IN {_SQL_MONTH_ENDS} AS l_shipdate_holiday,
       CASE WHEN l_returnflag <> 'N' THEN CAST(l_shipdate AS DATE) + 1 IN {_SQL_MONTH_ENDS} END AS arrival_holiday
FROM lineitem"""

QUERIES = {
    "merge_inner": (_joined("inner"), _SQL_INNER),
    "merge_left": (_joined("left"), _SQL_LEFT),
    "merge_left_unique": (_joined("left", "right"), _SQL_LEFT),
    "merge_right": (_joined("right"), _SQL_RIGHT),
    "merge_full": (_joined("full"), _SQL_FULL),
    "merge_semi": (_joined("semi"), _SQL_SEMI),
    "merge_anti": (_joined("anti"), _SQL_ANTI),
    "merge_clash": (merge_clash, MERGE_CLASH),
    "merge_full_same_key": (merge_full_same_key, MERGE_FULL_SAME_KEY),
    "merge_two_keys": (merge_two_keys, MERGE_TWO_KEYS),
    "keep_referenced": (keep_referenced_query, KEEP_REFERENCED),
    "count_referenced": (count_referenced_query, COUNT_REFERENCED),
    "flag_membership": (_membership(None), FLAG_MEMBERSHIP),
    "flag_membership_unbroadcast": (_membership(0), FLAG_MEMBERSHIP),
}
