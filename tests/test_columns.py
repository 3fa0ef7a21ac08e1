import datetime
import math
import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions import parse_boolean, parse_timestamp, weekday_name
from tidemark.operators import slices
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


def test_where_keeps_true_rows(spark, rows):
    df = spark.createDataFrame([(7, "oak"), (90, "elm"), (None, "ash"), (91, "fir")], "height long, tree string")
    assert rows(where(df, "height > 10")) == [(90, "elm"), (91, "fir")]
    assert rows(where(df, (F.col("height") > 50) & (F.col("tree") == "fir"))) == [(91, "fir")]


@pytest.mark.parametrize("condition", ["", "  ", "height + 1", "no_such > 1"])
def test_where_refuses_bad_conditions(spark, condition):
    df = spark.createDataFrame([(1,)], "height long")
    with pytest.raises(Exception):
        where(df, condition)


def test_where_refuses_other_types(spark):
    with pytest.raises(TypeError):
        where(spark.range(1), 5)


def test_drop_duplicates(spark, rows):
    df = spark.createDataFrame([("p", 70), ("q", 80), ("p", 70), ("p", 70)], "code string, size long")
    assert rows(drop_duplicates(df, ["code"])) == [("p", 70), ("q", 80)]
    assert rows(drop_duplicates(spark.createDataFrame([(5, None), (5, None)], "m long, n long"))) == [(5, None)]


def test_drop_duplicates_keeps_the_first_in_order(spark, rows):
    df = spark.createDataFrame(
        [("x", 2, "late"), ("x", 1, "early"), (None, 5, "b"), (None, 4, "a")], "k string, at long, v string"
    )
    assert rows(drop_duplicates(df, ["k"], order_by=["at"]), "k", "v") == [("x", "early"), (None, "a")]
    latest = drop_duplicates(df, ["k"], order_by=[F.col("at").desc()])
    assert rows(latest, "k", "v") == [("x", "late"), (None, "b")]
    with pytest.raises(ValueError):
        drop_duplicates(df, ["missing"])


def test_drop_duplicates_reduces_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS at")
    plan = drop_duplicates(df, ["k"], order_by=["at"])._jdf.queryExecution().executedPlan().toString()
    before_exchange = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_exchange and "Partial" in before_exchange


def test_nulls(spark, rows):
    df = spark.createDataFrame([(1, "x"), (None, None), (3, "z")], "a long, b string")
    assert rows(drop_nulls(df, ["a"], fill={"b": "default"})) == [(1, "x"), (3, "z")]
    any_null = spark.createDataFrame([(1, None), (None, None), (3, "ok")], "a long, b string")
    assert rows(drop_nulls(any_null, any_column=True)) == [(3, "ok")]
    assert rows(drop_nulls(any_null)) == rows(any_null)


def test_nan_is_no_null(spark):
    df = spark.createDataFrame([(math.nan,), (None,), (1.0,)], "x double")
    assert drop_nulls(df, ["x"]).count() == 2
    filled = [r.x for r in fill_nulls(df, {"x": 0.0}).collect()]
    assert sorted(v for v in filled if not math.isnan(v)) == [0.0, 1.0] and any(math.isnan(v) for v in filled)


@pytest.mark.parametrize("column, value", [("n", 1.7), ("n", "z"), ("n", True), ("s", 1), ("missing", 0)])
def test_fill_refuses_values_of_another_type(spark, column, value):
    df = spark.createDataFrame([(1, "a")], "n long, s string")
    with pytest.raises(ValueError):
        fill_nulls(df, {column: value})


def test_rename(spark):
    df = spark.createDataFrame([(1, 2)], "a long, b long")
    assert rename_columns(df, {"a": "b", "b": "a"}).first().asDict() == {"b": 1, "a": 2}
    assert rename_columns(df, {"a": "nuevo"}).columns == ["nuevo", "b"]
    for names in ({}, {"zz": "y"}, {"a": "b"}):
        with pytest.raises(ValueError):
            rename_columns(df, names)


def test_names_with_dots_and_quotes(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` long, `c``d` long")
    assert rename_columns(df, {"a.b": "x"}).columns == ["x", "c`d"]
    assert keep_columns(df, ["c`d"]).first()[0] == 2
    assert drop_columns(df, ["a.b"]).columns == ["c`d"]


def test_drop_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a long, b long")
    assert drop_columns(df, ["b"]).columns == ["a"]
    with pytest.warns(UserWarning):
        assert drop_columns(df, []).columns == ["a", "b"]
    with pytest.raises(ValueError):
        drop_columns(df, ["zz"])


def test_cast(spark):
    df = spark.createDataFrame([("1", "true"), ("2", "false")], "a string, b string")
    cast = cast_columns(df, {"a": "int", "b": "bool"})
    assert cast.dtypes == [("a", "bigint"), ("b", "boolean")]
    assert [tuple(r) for r in cast.orderBy("a").collect()] == [(1, True), (2, False)]


def test_cast_skips_unknown_types_and_columns(spark):
    df = spark.createDataFrame([("x",), ("y",)], "a string")
    with pytest.warns(UserWarning):
        assert cast_columns(df, {"a": "unsupported"}).dtypes == df.dtypes
    with pytest.warns(UserWarning):
        assert cast_columns(df, {"missing": "int"}).dtypes == df.dtypes


def test_cast_makes_bad_text_null_and_counts_it(spark):
    from pyspark.sql import Observation

    df = spark.createDataFrame([("1.5",), (" 7 ",), ("x",), ("8",), (None,)], "a string")
    assert [r.a for r in cast_columns(df, {"a": "int"}).collect()] == [None, 7, None, 8, None]
    assert [r.a for r in cast_columns(df, {"a": "float"}).collect()] == [1.5, 7.0, None, 8.0, None]
    seen = Observation()
    cast_columns(df, {"a": "int"}, count_lost=seen).collect()
    assert seen.get == {"a": 2}


def test_boolean_words(spark):
    yes = ["t", "true", "1", "y", "yes", "v", "verdadero", "si"]
    no = ["f", "false", "0", "n", "no", "falso"]
    other = ["maybe", "", " t", "sí", None]
    words = yes + [w.upper() for w in yes] + no + [w.upper() for w in no] + other
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i long, w string")
    found = [r.b for r in df.orderBy("i").select(parse_boolean(F.col("w")).alias("b")).collect()]
    assert found == [True] * 16 + [False] * 12 + [None] * 5
    numbers = spark.createDataFrame([(1,), (0,), (2,)], "n long").select(parse_boolean(F.col("n")).alias("b"))
    assert [r.b for r in numbers.collect()] == [True, False, None]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2021-04-30", datetime.datetime(2021, 4, 30)),
        ("2021-04-30 07:22", datetime.datetime(2021, 4, 30, 7, 22)),
        ("2021-04-30 07:22:36", datetime.datetime(2021, 4, 30, 7, 22, 36)),
        ("2021-04-30T07:22:36.615023", datetime.datetime(2021, 4, 30, 7, 22, 36, 615023)),
        ("2021-04-30T07:22:36.615023999", datetime.datetime(2021, 4, 30, 7, 22, 36, 615023)),
        ("2021/04/30 07:22:36", datetime.datetime(2021, 4, 30, 7, 22, 36)),
        ("30/04/2021 07:22:36", datetime.datetime(2021, 4, 30, 7, 22, 36)),
        ("30-04-2021", datetime.datetime(2021, 4, 30)),
        ("2021-02-30", None),
        ("2021", None),
        ("2021-04-30 07:22:36+02:00", None),
        ("today", None),
        ("", None),
        (None, None),
    ],
)
def test_timestamps(spark, text, expected):
    df = spark.createDataFrame([(text,)], "a string").select(parse_timestamp(F.col("a")).alias("a"))
    assert df.dtypes == [("a", "timestamp_ntz")] and df.first().a == expected


def test_timestamps_of_given_formats(spark):
    df = spark.createDataFrame([("04.2021.30",), ("2021-04-30",)], "a string")
    found = df.select(parse_timestamp(F.col("a"), ["MM.yyyy.dd", "yyyy-MM-dd"]).alias("a")).collect()
    assert [r.a for r in found] == [datetime.datetime(2021, 4, 30)] * 2


def test_timestamp_cast_leaves_other_types(spark):
    df = spark.sql("SELECT DATE'2021-04-30' AS d, TIMESTAMP_NTZ'2021-04-30 01:02:03' AS t, 5L AS n")
    with pytest.warns(UserWarning):
        assert cast_columns(df, {"d": "timestamp", "t": "timestamp", "n": "timestamp"}).dtypes == df.dtypes


def test_dates(spark):
    names = ["Lunes", "Martes", "Miercoles", "Jueves", "Viernes", "Sabado", "Domingo"]
    df = spark.createDataFrame([(datetime.date(2025, 1, d),) for d in range(6, 13)], "date date")
    found = df.transform(add_date_parts).transform(add_weekday_name).orderBy("date").collect()
    assert [r.weekday for r in found] == names
    assert [(r.day, r.month, r.year) for r in found] == [(d, 1, 2025) for d in range(6, 13)]
    shifted = add_weekday_name(df, compat_shift=True).orderBy("date").collect()
    assert [r.weekday for r in shifted] == names[1:] + [None]
    assert spark.sql("SELECT CAST(NULL AS DATE) AS d").select(weekday_name(F.col("d"))).first()[0] is None


def test_columns_of_kind(spark):
    df = spark.createDataFrame([], "n long, x double, s string, sent_at string, date string, t timestamp_ntz, b boolean")
    assert columns_of_kind(df, "numeric") == ["n", "x"]
    assert columns_of_kind(df, "text") == ["s"]
    assert columns_of_kind(df, "date") == ["sent_at", "date", "t"]
    with pytest.raises(ValueError):
        columns_of_kind(df, "other")


def test_add_columns_all_see_the_input(spark):
    df = spark.createDataFrame([(1, 2)], "a long, b long")
    assert add_columns(df, {"a": "b", "b": F.col("a") + 10}).first().asDict() == {"a": 2, "b": 11}


def test_union_needs_equal_schemas(spark, rows):
    one, two = spark.createDataFrame([(1, "a")], "a long, b string"), spark.createDataFrame([(1, "a")], "a long, b string")
    assert rows(union_rows(one, two)) == [(1, "a"), (1, "a")]
    for other in ("a int, b string", "b string, a long", "a long"):
        with pytest.raises(ValueError):
            union_rows(one, spark.createDataFrame([], other))


def test_slices(spark, tmp_path):
    path = str(tmp_path / "numbered")
    df = spark.range(0, 1000, 1, 7).selectExpr("(id * 37) % 1000 AS k")
    near = [r.k for r in slice_rows(df, ["k"], 100, 50).collect()]
    far = sorted(r.k for r in slice_rows(df, ["k"], 100, 50, path=path).collect())
    assert near == far == list(range(100, 150))
    assert os.path.exists(path)
    assert slice_rows(df, ["k"], 990, 50).count() == 10
    assert first_rows(df).count() == 5
    with pytest.raises(ValueError):
        slice_rows(df, ["k"], -1, 5)


def test_row_numbers_follow_the_order(spark, tmp_path):
    df = spark.range(0, 5000, 1, 6).selectExpr("id % 2 AS hot", "pmod(xxhash64(id), 1000003) AS k", "id")
    numbered = number_rows(df, ["hot", F.col("k").desc(), "id"], path=str(tmp_path / "n"))
    found = numbered.orderBy("row_number").collect()
    assert [r.row_number for r in found] == list(range(5000))
    assert [(r.hot, -r.k, r.id) for r in found] == sorted((r.hot, -r.k, r.id) for r in found)


@pytest.mark.parametrize(("offset", "length"), [(0, 10), (30_000, 25), (59_990, 100), (61_000, 5), (12_345, 0), (5, 59_000)])
def test_slices_are_selected(spark, monkeypatch, offset, length):
    """Over a composite key with nulls, ties in its first column and a descending part, in several rounds."""
    monkeypatch.setattr(slices, "SORTED_ROWS", 500)
    df = spark.range(0, 60_000, 1, 6).selectExpr(
        "CASE WHEN id % 4 > 0 THEN id % 3 END AS hot", "CASE WHEN id % 9 > 0 THEN CAST(pmod(xxhash64(id), 5000) AS DOUBLE) END AS x", "id"
    )
    order = [F.col("hot").desc(), F.col("x"), "id"]
    found = slice_rows(df, order, offset, length)
    expected = df.orderBy(F.col("hot").desc(), F.col("x"), "id").collect()[offset : offset + length]
    assert found.collect() == expected
    assert "Write" not in found._jdf.queryExecution().executedPlan().toString()


def test_slices_need_a_total_order(spark, monkeypatch):
    monkeypatch.setattr(slices, "SORTED_ROWS", 500)
    with pytest.raises(ValueError, match="total order"):
        slice_rows(spark.range(5000).selectExpr("id % 2 AS k"), ["k"], 700, 5)


def test_slices_by_other_expressions(spark, tmp_path):
    df = spark.range(0, 100, 1, 3)
    found = slice_rows(df, [F.col("id") % 10, "id"], 10, 3, path=str(tmp_path / "n"))
    assert sorted(r.id for r in found.collect()) == [1, 11, 21]
