import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import rate, round_half_even
from tidemark.operators import quantiles
from tidemark.operators.quantiles import exact_quantiles
from tidemark.operators import (
    correlation,
    correlation_matrix,
    count_duplicates,
    describe,
    distinct_counts,
    distinct_estimates,
    distinct_sketches,
    flag_rates,
    merge_sketches,
    null_counts,
    numeric_stats,
    quality_report,
)

FLAGS = "is_opened long, is_clicked long, is_purchased long, is_unsubscribed long, is_hard_bounced long, is_soft_bounced long"
MESSAGES = [
    (1, 11, 1, 1, 1, 0, 0, 0),
    (1, 12, 0, 0, 0, 1, 0, 0),
    (2, 21, 1, 1, 0, 0, 0, 1),
    (2, 22, 1, 0, 0, 0, 1, 0),
    (2, 23, 0, 0, 0, 1, 0, 0),
]


def test_performance(spark, rows):
    df = spark.createDataFrame(MESSAGES, f"campaign_id long, message_id long, {FLAGS}")
    expected = [
        (1, 2, 1, 1, 1, 1, 0, 0.5, 1.0, 1.0, 0.5, 0.0),
        (2, 3, 2, 1, 0, 1, 2, 0.67, 0.5, 0.0, 0.33, 0.67),
    ]
    assert rows(flag_rates(df)) == expected
    booleans = df.withColumns({c.split()[0]: F.col(c.split()[0]).cast("boolean") for c in FLAGS.split(", ")})
    assert rows(flag_rates(booleans)) == expected


def test_performance_without_ids_and_flags(spark):
    df = spark.createDataFrame(
        [(None, None, 1, None, None, None, None, 1), (5, 1, None, None, None, None, None, 0)],
        f"campaign_id long, message_id long, {FLAGS}",
    )
    by_key = {r.campaign_id: r.asDict() for r in flag_rates(df).collect()}
    nobody = by_key[None]
    assert (nobody["total_sent"], nobody["total_opened"], nobody["total_bounced"]) == (0, 1, 1)
    assert nobody["open_rate"] is None and nobody["bounce_rate"] is None
    assert nobody["click_rate"] == 0.0 and nobody["conversion_rate"] == 0.0
    five = by_key[5]
    assert [five[f"total_{n}"] for n in ("sent", "opened", "clicked", "purchased", "unsubscribed", "bounced")] == [
        1,
        0,
        0,
        0,
        0,
        0,
    ]
    assert five["open_rate"] == 0.0


def test_flags_that_are_not_plain_yes_or_no(spark):
    df = spark.createDataFrame([(1, 1)], "k long, id long")
    with pytest.raises(ValueError):
        flag_rates(df, "k", "id")
    with pytest.raises(ValueError):
        flag_rates(df, "k", "id", flags={"forwarded": ["id"]})


def test_rounding(spark):
    pairs = [(1, 8, 0.12), (23, 40, 0.57), (9, 200, 0.04), (2, 3, 0.67), (1, 1, 1.0)]
    df = spark.createDataFrame([p[:2] for p in pairs], "n long, d long")
    found = df.select(round_half_even(rate(F.col("n"), F.col("d"))).alias("r")).collect()
    assert [r.r for r in found] == [p[2] for p in pairs]


def test_only_needed_columns_are_shuffled(spark, tmp_path):
    df = spark.createDataFrame(MESSAGES, f"campaign_id long, message_id long, {FLAGS}").withColumn("text", F.lit("x"))
    df.write.parquet(str(tmp_path / "m"))
    plan = flag_rates(spark.read.parquet(str(tmp_path / "m")))._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan and plan.count("Exchange") == 1 and "partial_count" in plan


def _report(df, rules, **options):
    found = quality_report(df, rules, **options).orderBy("orden").collect()
    return [(r.columna, r.regla, r.estado, r.detalle) for r in found]


def test_quality_rules(spark):
    df = spark.createDataFrame(
        [
            (1, 0.0, "josé@x.co", 18, True, "2024-05-06 07:08:09", datetime.date(2024, 5, 6)),
            (1, -1.0, "a@b", 17, None, "2024-05-06T07:08:09.123", datetime.date(2030, 1, 1)),
            (None, None, None, None, False, "bad", None),
            (None, math.nan, "x y@z.com", 40, False, None, datetime.date(2024, 1, 1)),
        ],
        "id long, amount double, email string, age long, flag boolean, at string, day date",
    )
    rules = [
        ("id", "no_nulos"),
        ("amount", "valores_positivos"),
        ("email", "formato_email"),
        ("id", "no_duplicados"),
        ("email", "no_duplicados"),
        ("flag", "validacion_boolean"),
        ("id", "validacion_boolean"),
        ("day", "formato_fecha"),
        ("id", "formato_fecha"),
        ("at", "formato_fecha"),
        ("flag", "formato_fecha"),
        ("day", "fecha_no_futura"),
        ("at", "fecha_no_futura"),
        ("age", "edad_mayor_18"),
        ("id", "nulos_mayor_95"),
        ("id", "otra"),
        ("zz", "no_nulos"),
    ]
    assert _report(df, rules, as_of=datetime.date(2025, 1, 1)) == [
        ("id", "no_nulos", "FALLA", "2 valores nulos"),
        ("amount", "valores_positivos", "FALLA", "1 valores negativos"),
        ("email", "formato_email", "FALLA", "2 correos inválidos"),
        ("id", "no_duplicados", "FALLA", "2 duplicados encontrados"),
        ("email", "no_duplicados", "OK", "0 duplicados encontrados"),
        ("flag", "validacion_boolean", "OK", "Columna 'flag' es tipo booleano."),
        ("id", "validacion_boolean", "FALLA", "Valores no corresponden a booleanos"),
        ("day", "formato_fecha", "OK", "Columna 'day' ya es tipo date"),
        ("id", "formato_fecha", "OK", "Columna 'id' convertida desde timestamp numérico"),
        ("at", "formato_fecha", "FALLA", "2 fechas no reconocidas"),
        ("flag", "formato_fecha", "FALLA", "Tipo no compatible para fecha: boolean"),
        ("day", "fecha_no_futura", "FALLA", "1 registros con fecha futura"),
        ("at", "fecha_no_futura", "OK", "0 registros con fecha futura"),
        ("age", "edad_mayor_18", "FALLA", "1 registros con edad menor a 18"),
        ("id", "nulos_mayor_95", "OK", "50.00% de nulos en la columna"),
        ("id", "otra", "FALLA", "Regla 'otra' no reconocida"),
        ("zz", "no_nulos", "FALLA", "Columna no encontrada"),
        ("Total Registros", "", "", "4 de registros"),
    ]
    # Any kind of date, instead of the one fixed format.
    assert _report(df, [("at", "formato_fecha")], date_formats=None)[0][3] == "1 fechas no reconocidas"
    assert _report(df, [("at", "formato_fecha")], compat_dates=True)[0][2:] == ("OK", "Columna 'at' convertida desde string")


def test_quality_details(spark):
    """Line breaks after an address, shares that lie halfway, numbers as dates."""
    df = spark.createDataFrame([("a@b.co\n", 86400 * 3), ("a@b.co", 86400 * 2 + 86399), (None, None)], "email string, at long")
    rules = [("email", "formato_email"), ("at", "fecha_no_futura"), ("at", "formato_fecha")]
    found = _report(df, rules, as_of=datetime.date(1970, 1, 3))
    assert [r[3] for r in found[:2]] == ["1 correos inválidos", "1 registros con fecha futura"]
    wide = spark.range(4000).selectExpr(*[f"IF(id < {n}, NULL, id) AS c{n}" for n in (1, 3, 11, 13)])
    shares = _report(wide, [(f"c{n}", "nulos_mayor_95") for n in (1, 3, 11, 13)])
    assert [r[3][:4] for r in shares[:4]] == ["0.03", "0.07", "0.27", "0.33"]
    assert [r[3][:4] for r in shares[:4]] == [f"{n / 4000 * 100:.2f}" for n in (1, 3, 11, 13)]


def test_quality_of_a_wide_table(spark):
    df = spark.range(30).selectExpr(*[f"IF(id < {i}, NULL, id) AS c{i}" for i in range(90)])
    found = _report(df, [(f"c{i}", "no_nulos") for i in range(90)])
    assert [r[3] for r in found] == [f"{min(i, 30)} valores nulos" for i in range(90)] + ["30 de registros"]


def test_quality_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a long")
    assert _report(df, [("a", "nulos_mayor_95"), ("a", "no_duplicados"), ("a", "no_nulos")]) == [
        ("a", "nulos_mayor_95", "OK", "0.00% de nulos en la columna"),
        ("a", "no_duplicados", "OK", "0 duplicados encontrados"),
        ("a", "no_nulos", "OK", "0 valores nulos"),
        ("Total Registros", "", "", "0 de registros"),
    ]
    assert _report(df, []) == [("Total Registros", "", "", "0 de registros")]


def test_null_share_limit(spark):
    df = spark.range(1000).selectExpr("IF(id < 50, 1, NULL) AS at", "IF(id < 49, 1, NULL) AS above")
    states = [r[2:] for r in _report(df, [("at", "nulos_mayor_95"), ("above", "nulos_mayor_95")])]
    assert states[:2] == [("OK", "95.00% de nulos en la columna"), ("FALLA", "95.10% de nulos en la columna")]


def test_rules_refuse_columns_they_do_not_fit(spark):
    with pytest.raises(ValueError):
        quality_report(spark.createDataFrame([("a",)], "a string"), [("a", "valores_positivos")])


def test_profile(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (2, 4.0, None), (3, None, "c"), (3, None, "c")], "n long, x double, s string")
    stats = numeric_stats(df).first().asDict()
    assert (stats["n_mean"], stats["n_min"], stats["n_max"], stats["x_mean"]) == (2.25, 1, 3, 3.0)
    assert stats["x_std"] == pytest.approx(math.sqrt(2))
    assert null_counts(df).first().asDict() == {"n": 0, "x": 2, "s": 1}
    assert tuple(count_duplicates(df).first()) == (4, 3, 1)
    assert tuple(count_duplicates(df, ["s"]).first()) == (4, 3, 1)
    assert tuple(count_duplicates(df.filter("n > 9")).first()) == (0, 0, 0)
    assert correlation(df, [("n", "x")]).first()["n_x"] == pytest.approx(1.0)


def test_correlation_matrix(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 1.0, 5.0), (3.0, 0.0, 5.0)], "a double, b double, c double")
    found = {r["column"]: (r.a, r.b, r.c) for r in correlation_matrix(df).collect()}
    assert found["a"] == pytest.approx((1.0, -1.0, None), nan_ok=True) or found["a"][:2] == pytest.approx((1.0, -1.0))
    assert found["c"] == (None, None, None)


def test_wide_tables(spark):
    """More columns than one aggregation takes, of several types."""
    df = spark.range(1, 51).selectExpr(
        *[f"CAST(id * {i} AS {'BIGINT' if i % 2 else 'DOUBLE'}) AS c{i}" for i in range(1, 24)], "CAST(NULL AS INT) AS none"
    )
    stats = numeric_stats(df)
    found = stats.first()
    assert [found[f"c{i}_max"] for i in range(1, 24)] == [50 * i for i in range(1, 24)]
    assert dict(stats.dtypes)["c1_max"] == "bigint" and dict(stats.dtypes)["c2_max"] == "double"
    assert found.none_mean is None and stats.columns[:2] == ["c1_mean", "c2_mean"]
    matrix = correlation_matrix(df, [f"c{i}" for i in range(1, 8)]).collect()
    assert [[round(r[f"c{i}"], 9) for i in range(1, 8)] for r in matrix] == [[1.0] * 7] * 7


def test_describe(spark):
    df = spark.range(1, 102).selectExpr("CAST(id AS DOUBLE) AS x", "IF(id > 1, concat('n', id), NULL) AS s", "id > 50 AS b")
    found = {r.statistic: r for r in describe(df).collect()}
    assert (found["count"].x, found["null_count"].s, found["mean"].x) == (101.0, "1", 51.0)
    assert [found[s].x for s in ("min", "25%", "50%", "75%", "max")] == [1.0, 26.0, 51.0, 76.0, 101.0]
    sketched = {r.statistic: r for r in describe(df, exact=False).collect()}
    assert [sketched[s].x for s in ("25%", "50%", "75%")] == [26.0, 51.0, 76.0]
    assert found["min"].s == "n10" and found["50%"].s is None and found["mean"].b == pytest.approx(51 / 101)


def test_describe_moments(spark):
    df = spark.range(0, 101).selectExpr(
        "timestamp_ntz'1969-12-31 23:59:00' + make_dt_interval(0, 0, 0, id + 0.25) AS t",
        "IF(id < 3, date_add(DATE'2024-02-28', CAST(id AS INT)), NULL) AS d",
    )
    found = {r.statistic: r for r in describe(df).collect()}
    assert found["25%"].t == "1969-12-31 23:59:25.25" and found["mean"].t == "1969-12-31 23:59:50.25"
    assert found["50%"].d == "2024-02-29 00:00:00" and found["max"].d == "2024-03-01" and found["std"].t is None
    assert found["75%"].t == {r.statistic: r for r in describe(df, exact=False).collect()}["75%"].t


def test_quantiles_of_odd_numbers(spark):
    values = [float("-inf"), -1e308, -5e-324, 0.0, 5e-324, 1e308, float("inf"), float("inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = exact_quantiles(df, {"x": F.col("x")}, [i / 8 for i in range(9)], 64)["x"]
    assert found[:8] == values[:8] and math.isnan(found[8])


def test_correlations_with_nulls(spark):
    rng = random.Random(5)
    data = [tuple(rng.choice([None, rng.gauss(100, 1) + k * 0.3]) for _ in range(4)) + (7.5,) for k in range(400)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double, e double").repartition(5)
    found = {r["column"]: r for r in correlation_matrix(df).collect()}
    pairs = [(x, y) for x in "abcd" for y in "abcd" if x < y]
    expected = correlation(df, pairs).first()
    for x, y in pairs:
        assert found[x][y] == found[y][x] == pytest.approx(expected[f"{x}_{y}"], abs=1e-9)
    assert found["e"]["a"] is None and found["a"]["a"] == 1.0


def _nearest(values, share):
    known = sorted(v for v in values if v is not None)
    return known[math.floor((len(known) - 1) * share + 0.5)] if known else None


@pytest.mark.parametrize("stretches", [64, 4096])
@pytest.mark.parametrize(
    "expression",
    [
        "pmod(xxhash64(id), 100003)",
        "IF(id % 3 = 0, 7, pmod(xxhash64(id), 50))",
        "IF(id % 3 = 0, NULL, -id)",
        "id * id",
        "5",
        "IF(id < 2, id, NULL)",
        "IF(id < 1, id, NULL)",
        "CAST(NULL AS INT)",
    ],
)
def test_quantiles_are_exact_however_coarse_the_stretches(spark, expression, stretches):
    df = spark.range(0, 3000, 1, 5).selectExpr(f"CAST({expression} AS DOUBLE) AS x")
    shares = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    values = [r.x for r in df.collect()]
    found = exact_quantiles(df, {"x": F.col("x")}, shares, stretches)
    assert found == {"x": [_nearest(values, s) for s in shares]}


@pytest.mark.parametrize(
    "values", [[0.0, 5e-324, 1e-323], [1.0, 1.0 + 2**-52, 1.0 + 2**-51], [-1e308, -5e-324, 1e308], [7.0] * 5]
)
def test_quantiles_end_in_six_scans(spark, monkeypatch, values):
    """Whatever the values: neighbours in the last bit, denormal ones, far apart ones."""
    scans, counted = [], quantiles._counted
    monkeypatch.setattr(quantiles, "_counted", lambda *args: scans.append(args) or counted(*args))
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(2)
    found = exact_quantiles(df, {"x": F.col("x")}, [0.0, 0.5, 1.0])
    assert found["x"] == [values[0], values[len(values) // 2], values[-1]]
    assert 1 <= len(scans) <= 6
    with pytest.raises(ValueError):
        exact_quantiles(df, {"x": F.col("x")}, [0.5], 1000)


def test_quantiles_of_columns_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, -0.0)], "x double, y double")
    assert exact_quantiles(df, {"x": F.col("x"), "y": F.col("y")}, [0.0, 1.0]) == {"x": [None, None], "y": [0.0, 1.0]}
    assert exact_quantiles(df.limit(0), {"y": F.col("y")}, [0.5]) == {"y": [None]}


def test_correlations_with_not_a_number(spark):
    nan = float("nan")
    data = [(1.0, 2.0, 1.0, 5.0), (2.0, 1.0, nan, 5.0), (3.0, 5.0, 2.0, 5.0), (4.0, 4.0, 3.0, 5.0), (nan, None, None, None)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double").repartition(3)
    found = {r["column"]: r for r in correlation_matrix(df).collect()}
    expected = correlation(df, [("a", "b"), ("b", "c"), ("a", "c")]).first()
    assert found["a"]["b"] == pytest.approx(expected["a_b"]) and expected["a_b"] == pytest.approx(0.7071, abs=1e-4)
    assert math.isnan(expected["b_c"]) and math.isnan(found["b"]["c"]) and math.isnan(found["c"]["b"])
    assert math.isnan(found["a"]["a"]) and math.isnan(found["c"]["c"]) and found["b"]["b"] == 1.0
    assert found["d"]["d"] is None and found["d"]["b"] is None
    infinite = spark.createDataFrame([(1.0, 1.0), (float("inf"), 2.0), (3.0, 5.0)], "a double, b double")
    assert math.isnan(correlation_matrix(infinite).first()["b"])


def test_distinct_counts(spark, rows):
    nan = float("nan")
    data = [(1, "a", 0.0, b"\xff", None), (1, "", -0.0, b"\xfe", None), (2, None, nan, b"\xff", None), (None, "a", nan, None, None)]
    df = spark.createDataFrame(data, "i int, s string, x double, b binary, n date").repartition(3)
    found = rows(distinct_counts(df))
    assert found == [("b", 4, 1, 2, 1), ("i", 4, 1, 2, 1), ("n", 4, 4, 0, 0), ("s", 4, 1, 2, 1), ("x", 4, 0, 2, 2)]
    assert rows(distinct_counts(df.limit(0), ["i", "n"])) == [("i", 0, 0, 0, 0), ("n", 0, 0, 0, 0)]
    with pytest.raises(TypeError):
        distinct_counts(spark.createDataFrame([([1],)], "a array<int>"))
    plan = distinct_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") <= 2 and plan.count("Exchange hashpartitioning") == 2


def test_distinct_sketches(spark):
    """Within four standard errors over numbers of very different size; parts merge to the whole's sketch."""
    df = spark.range(0, 60_000, 1, 4).selectExpr("id", "id % 7 AS few", "id % 1000 AS some", "CAST(id % 20000 AS STRING) AS many", "id % 3 AS part")
    columns, numbers = ["id", "few", "some", "many"], [60_000, 7, 1000, 20_000]
    for bits in (10, 14):
        whole = distinct_estimates(distinct_sketches(df, columns, bits)).first()
        parts = distinct_sketches(df, columns, bits, by=["part"])
        assert parts.count() == 3
        merged = distinct_estimates(merge_sketches(parts, columns)).first()
        for name, n in zip(columns, numbers):
            bound = max(1, 4 * 1.04 / 2 ** (bits / 2) * n)
            assert abs(whole[name] - n) <= bound and abs(merged[name] - n) <= bound
    grouped = distinct_estimates(distinct_sketches(df, ["few"], by=["part"]), ["few"])
    assert sorted(tuple(r) for r in grouped.collect()) == [(0, 7), (1, 7), (2, 7)]
