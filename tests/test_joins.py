import datetime
import itertools

import pytest
from pyspark.sql import functions as F

from tidemark.operators import count_referenced, flag_membership, keep_referenced, merge

DAY = datetime.date


def _sides(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], "id long, val1 string")
    right = spark.createDataFrame([(2, "x"), (3, "y"), (4, "z"), (None, "m")], "id long, val2 string")
    return left, right


def test_inner(spark, rows):
    joined = merge(*_sides(spark), on="id")
    assert joined.columns == ["id", "val1", "val2"]
    assert rows(joined) == [(2, "b", "x"), (3, "c", "y")]


EXPECTED = {
    "left": (["id", "val1", "val2"], [(1, "a", None), (2, "b", "x"), (3, "c", "y"), (None, "n", None)]),
    "right": (["val1", "id", "val2"], [("b", 2, "x"), ("c", 3, "y"), (None, 4, "z"), (None, None, "m")]),
    "full": (
        ["id", "val1", "id_right", "val2"],
        [
            (1, "a", None, None),
            (2, "b", 2, "x"),
            (3, "c", 3, "y"),
            (None, "n", None, None),
            (None, None, 4, "z"),
            (None, None, None, "m"),
        ],
    ),
    "semi": (["id", "val1"], [(2, "b"), (3, "c")]),
    "anti": (["id", "val1"], [(1, "a"), (None, "n")]),
}
EXPECTED["outer"] = EXPECTED["full"]


@pytest.mark.parametrize("how, unique", list(itertools.product(EXPECTED, [None, "left", "right", "both"])))
def test_other_joins(spark, rows, how, unique):
    joined = merge(*_sides(spark), on=["id"], how=how, unique=unique)
    columns, expected = EXPECTED[how]
    assert joined.columns == columns
    assert rows(joined) == sorted(expected, key=repr)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_repeated_keys_multiply_as_in_a_plain_join(spark, rows, how):
    left = spark.createDataFrame([(k, i) for i, k in enumerate([1, 1, 1, 2, 5])], "k long, a long")
    right = spark.createDataFrame([(k, i) for i, k in enumerate([1, 1, 2, 2, 7])], "k long, b long")
    split = merge(left, right, on="k", how=how)
    plain = merge(left, right, on="k", how=how, unique="both")
    assert rows(split) == rows(plain)


def test_names(spark):
    left = spark.createDataFrame([(1, "a", 5)], "client_id long, name string, id long")
    right = spark.createDataFrame([(1, "b", 6)], "id long, name string, age long")
    joined = merge(left, right, left_on="client_id", right_on="id", how="left")
    assert joined.columns == ["client_id", "name", "id", "name_right", "age"]
    assert tuple(joined.first()) == (1, "a", 5, "b", 6)
    assert merge(left, right, left_on="client_id", right_on="id", how="right").columns == [
        "name",
        "id",
        "id_right",
        "name_right",
        "age",
    ]


def test_self_join(spark, rows):
    df = spark.createDataFrame([(1, 10), (2, 20)], "id long, boss long")
    assert rows(merge(df, df, on="id", how="full"), "id", "boss", "boss_right") == [(1, 10, 10), (2, 20, 20)]


@pytest.mark.parametrize(
    "options",
    [
        {"on": "id", "how": "cross"},
        {"on": "id", "how": "theta"},
        {},
        {"left_on": "id"},
        {"on": "zz"},
        {"left_on": ["id", "val1"], "right_on": ["id"]},
        {"left_on": "val1", "right_on": "id"},
        {"on": "id", "unique": "yes"},
    ],
)
def test_bad_joins(spark, options):
    with pytest.raises((ValueError, TypeError)):
        merge(*_sides(spark), **options)


def test_keep_referenced(spark, rows):
    messages = spark.createDataFrame(
        [(1, 10, "a"), (2, 20, "b"), (3, 30, "c"), (4, 40, "d"), (None, 10, "e")], "campaign_id long, client_id long, message string"
    )
    campaigns = spark.createDataFrame([(1,), (3,), (3,), (None,)], "id long")
    clients = spark.createDataFrame([(10,), (30,)], "client_id long")
    kept = keep_referenced(messages, [("campaign_id", campaigns, "id"), ("client_id", clients, "client_id")])
    assert rows(kept) == [(1, 10, "a"), (3, 30, "c")]
    assert count_referenced(messages, "client_id", clients, "client_id").first().rows == 3
    with pytest.raises(ValueError):
        keep_referenced(messages, [])


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_membership(spark, limit):
    df = spark.createDataFrame([("2025-01-01",), ("2025-01-02",), ("2025-01-03",)], "fecha string")
    festivos = spark.createDataFrame([("2025-01-01",), ("2025-01-06",), ("2025-01-01",), (None,)], "festivo string")
    flagged = flag_membership(df, ["fecha"], festivos, "festivo", broadcast_rows=limit).orderBy("fecha")
    assert flagged.columns == ["fecha", "fecha_holiday"]
    assert [r.fecha_holiday for r in flagged.collect()] == [True, False, False]


def test_membership_of_null_is_null(spark):
    at = datetime.datetime
    df = spark.createDataFrame(
        [(1, at(2025, 1, 1, 23), None), (2, None, at(2025, 1, 6))], "i long, a timestamp_ntz, b timestamp_ntz"
    )
    days = spark.createDataFrame([(DAY(2025, 1, 1),), (None,)], "d date")
    found = flag_membership(df, ["a", "b"], days, "d").orderBy("i").collect()
    assert [(r.a_holiday, r.b_holiday) for r in found] == [(True, None), (None, False)]


def test_membership_broadcasts_one_list_for_all_columns(spark):
    day = "date_add(DATE'2025-01-01', CAST(id % {} AS INT))"
    df = spark.range(1000).selectExpr(f"{day.format(90)} AS a", f"{day.format(50)} AS b")
    days = spark.range(30).selectExpr("date_add(DATE'2025-01-01', CAST(id AS INT)) AS d")
    flagged = flag_membership(df, ["a", "b"], days, "d")
    flagged.collect()
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "ReusedExchange" in plan


@pytest.fixture
def eager_splitting(spark):
    """Small tables treated as large ones: no broadcast, low skew thresholds."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


HOT = "IF(id % 3 = 0, 7, id % 5000)"


@pytest.mark.parametrize("how, unique", [(h, u) for h in ("inner", "left", "semi", "anti") for u in (None, "right")])
def test_hot_key_on_the_left_is_split(spark, eager_splitting, how, unique):
    """A key with a third of all rows of a large join is read by several tasks."""
    left = spark.range(0, 60000, 1, 8).selectExpr(f"{HOT} AS k", "id AS a")
    right = spark.range(0, 5000, 1, 2).selectExpr("id AS k", "id AS b")
    joined = merge(left, right, on="k", how=how, unique=unique)
    plan = _executed(joined)
    assert plan.count("skew=true") == plan.count("SortMergeJoin")
    assert joined.count() == (0 if how == "anti" else 60000)


@pytest.mark.parametrize("how", ["left", "full"])
def test_hot_key_on_the_right_is_split(spark, eager_splitting, how):
    """Here the hot key is on the side that an outer join does not split."""
    left = spark.range(0, 6000, 1, 2).selectExpr("id AS k", "id AS b")
    right = spark.range(0, 60000, 1, 8).selectExpr(f"{HOT} AS k", "id AS a")
    joined = merge(left, right, on="k", how=how)
    plan = _executed(joined)
    assert "FullOuter" not in plan and "LeftOuter" not in plan
    # The join that finds left rows without a partner meets collapsed keys: nothing to split.
    assert plan.count("skew=true") == plan.count("SortMergeJoin") - 1
    assert joined.count() == 60000 + 1000


def test_hot_reference_keys_are_split(spark, eager_splitting):
    facts = spark.range(0, 60000, 1, 8).selectExpr(f"{HOT} AS k", "id % 100 AS g", "id AS a")
    keys = spark.range(0, 9000, 1, 4).selectExpr("id % 4000 AS k")
    kept = keep_referenced(facts, [("k", keys, "k")])
    assert "skew=true" in _executed(kept)
    assert kept.count() == facts.filter("k < 4000").count()


def test_hot_days_are_split(spark, eager_splitting):
    day = "date_add(DATE'2020-01-01', CAST({} AS INT))"
    facts = spark.range(0, 60000, 1, 8).selectExpr(f"IF(id % 3 = 1, NULL, {day.format(HOT)}) AS d", "id")
    days = spark.range(0, 5000, 1, 2).selectExpr(f"{day.format('id')} AS d")
    flagged = flag_membership(facts, ["d"], days, "d", broadcast_rows=0)
    plan = _executed(flagged)
    assert "skew=true" in plan and "BroadcastHashJoin" not in plan
    assert flagged.filter("d_holiday").count() == 40000 and flagged.count() == 60000


def test_whole_numbers_do_not_join_with_fractions(spark):
    big = spark.createDataFrame([(2**53 + 1,)], "k long")
    near = spark.createDataFrame([(float(2**53),)], "k double")
    with pytest.raises(TypeError):
        merge(big, near, on="k")
    assert merge(big, spark.createDataFrame([(5,)], "k int"), on="k").count() == 0
    assert merge(big.selectExpr("CAST(5 AS INT) k"), spark.createDataFrame([(5,)], "k long"), on="k").count() == 1


def test_a_unique_side_that_was_grouped_is_dealt_anew(spark):
    """So that a hot key of the other side can be split under default settings."""
    forced = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    settings = {
        forced: "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 60_000, 1, 8).selectExpr("IF(id % 3 = 0, 7, id % 500) AS k", "id")
        most = rows.groupBy("k").agg(F.max("id").alias("most"))
        joined = merge(rows, most, on="k", how="left", unique="right")
        assert joined.count() == 60_000
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_known_messages_shuffle_once_for_each_reference(spark):
    from tidemark.plans import known_messages

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        messages = spark.range(0, 100, 1, 4).selectExpr("id AS campaign_id", "id + 1 AS client_id")
        campaigns, clients = spark.range(0, 50, 1, 4).toDF("id"), spark.range(0, 70, 1, 4).toDF("client_id")
        known = known_messages(messages, campaigns, clients)
        plan = known._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 4 and "Aggregate" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
