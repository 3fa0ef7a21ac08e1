"""Profiling a table; each function is one aggregation over the columns it names."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import pearson
from ..naming import ref, require_columns, type_of
from .columns import columns_of_kind
from .quantiles import exact_quantiles

_PAIRS_PER_SCAN = 8
_ROUNDING = 1e-12
_COLUMNS_PER_SCAN = 10


def in_parts(df: DataFrame, measures: dict[str, Column], size: int) -> DataFrame:
    """One row of aggregates, ``size`` of them per aggregation over their own columns.

    With too many in one aggregation the generated code outgrows what the JVM compiles
    and runs about ten times slower (measured), so that several narrow scans beat a
    single wide one.
    """
    items = list(measures.items())
    parts = [
        df.agg(*[m.alias(n) for n, m in items[start : start + size]]) for start in range(0, len(items), size)
    ]
    if len(parts) == 1:
        return parts[0]
    # Each column is known in the row of one part only.
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return together.agg(*[F.max(ref(n)).alias(n) for n in measures])


def numeric_stats(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row with ``<column>_mean``, ``_min``, ``_max`` and ``_std`` (sample)."""
    columns = require_columns(df, columns or columns_of_kind(df, "numeric"))
    stats = {"mean": F.mean, "min": F.min, "max": F.max, "std": F.stddev_samp}
    measures = {f"{c}_{name}": f(ref(c)) for c in columns for name, f in stats.items()}
    ordered = [ref(f"{c}_{name}") for name in stats for c in columns]
    return in_parts(df, measures, _COLUMNS_PER_SCAN * len(stats)).select(ordered)


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row with the number of nulls of each column, under the column's name."""
    columns = require_columns(df, columns or df.columns)
    return in_parts(df, {c: F.count_if(ref(c).isNull()) for c in columns}, 4 * _COLUMNS_PER_SCAN)


def count_duplicates(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row: ``rows``, ``distinct_rows`` and ``duplicates`` over the keys (or all
    columns); nulls count as a value."""
    keys = require_columns(df, keys or df.columns)
    groups = df.groupBy(*[ref(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_rows")
    ).withColumn("duplicates", ref("rows") - ref("distinct_rows"))


def correlation(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """One row with the Pearson correlation ``<a>_<b>`` of each pair of columns.

    A pair ignores rows where one of the two is null. Not-a-number is a value: where a row that
    counts holds it, the correlation is not a number; so it is with an infinite value.
    """
    require_columns(df, [c for pair in pairs for c in pair])
    measures = {f"{a}_{b}": pearson(ref(a), ref(b)) for a, b in pairs}
    if not pairs or len(measures) < len(pairs):
        raise ValueError(f"no pairs, or pairs with the same name: {pairs}")
    return in_parts(df, measures, _PAIRS_PER_SCAN)


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson correlations of all numeric columns, one row per ``column``.

    Each pair ignores rows where one of the two is null; a constant column has no
    correlation with anything, itself included. Not-a-number is a value: a pair with a row that
    holds it, or an infinite value, has not-a-number for its correlation. Two scans, whatever the number of
    columns, run when this is called: one for each column's mean and range, one for the
    products of the columns less their means, in blocks of rows. A task sends one row for
    each pair of columns.
    """
    columns = require_columns(df, columns or columns_of_kind(df, "numeric"))
    spark, width = df.sparkSession, len(columns)
    values = [ref(c).cast("double") for c in columns]
    cells = df.select(F.posexplode(F.array(*values)).alias("i", "value")).where("abs(value) < double('Infinity')")
    ranges = cells.groupBy("i").agg(F.mean("value").alias("mean"), F.min("value").alias("low"), F.max("value").alias("high"))
    found = {r["i"]: r for r in ranges.collect()}
    means = np.array([found[i]["mean"] if i in found else 0.0 for i in range(width)])
    varies = [i in found and found[i]["low"] < found[i]["high"] for i in range(width)]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((5, width, width))
        for batch in batches:
            known = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(float)
            x = np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            finite = known * np.isfinite(x)
            # Any finite value would do to take off; a mean keeps the sums small.
            x = np.where(finite > 0, x, means) - means
            sums += np.stack([finite.T @ finite, x.T @ finite, (x * x).T @ finite, x.T @ x, known.T @ known])
        i, j = np.triu_indices(width)
        named = {"n": sums[0][i, j], "all": sums[4][i, j], "x": sums[1][i, j], "y": sums[1][j, i]}
        named |= {"xx": sums[2][i, j], "yy": sums[2][j, i], "xy": sums[3][i, j]}
        yield pa.RecordBatch.from_pydict({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32())} | named)

    schema = "i int, j int, n double, `all` double, x double, y double, xx double, yy double, xy double"
    blocks = df.select([v.alias(f"c{i}") for i, v in enumerate(values)]).mapInArrow(products, schema)
    sums = blocks.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "all", "x", "y", "xx", "yy", "xy")])
    results: dict[tuple[int, int], float | None] = {(i, i): 1.0 if varies[i] else None for i in range(width)}
    for r in sums.collect():
        if r["n"] < r["all"]:
            results[r["i"], r["j"]] = results[r["j"], r["i"]] = float("nan")
        if r["n"] < r["all"] or r["i"] == r["j"]:
            continue
        xx, yy = r["n"] * r["xx"] - r["x"] ** 2, r["n"] * r["yy"] - r["y"] ** 2
        # What is left of a constant's square after subtracting it is rounding.
        constant = xx <= _ROUNDING * r["n"] * r["xx"] or yy <= _ROUNDING * r["n"] * r["yy"]
        value = None if constant else (r["n"] * r["xy"] - r["x"] * r["y"]) / math.sqrt(xx * yy)
        results[r["i"], r["j"]] = results[r["j"], r["i"]] = value
    rows = [(c, *[results.get((i, j)) for j in range(width)]) for i, c in enumerate(columns)]
    schema = T.StructType([T.StructField("column", T.StringType())] + [T.StructField(c, T.DoubleType()) for c in columns])
    return spark.createDataFrame(rows, schema)


def _day_micros(c: Column) -> Column:
    """Microseconds since 1970 of a date or timestamp as its clock shows it, as a double."""
    ntz = c.cast("timestamp_ntz")
    days = F.datediff(ntz.cast("date"), F.lit("1970-01-01").cast("date")).cast("double")
    seconds = F.hour(ntz) * 3600 + F.minute(ntz) * 60 + F.extract(F.lit("SECOND"), ntz)
    return days * 86_400e6 + F.rint(seconds.cast("double") * 1e6)


def _clock_text(micros: Column) -> Column:
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    days = F.floor(micros / 86_400e6).cast("int")
    rest = ((micros - days * F.lit(86_400e6)) / 1e6).cast("decimal(18,6)")
    moment = start + F.make_dt_interval(days, F.lit(0), F.lit(0), rest)
    return moment.cast("string")


def describe(
    df: DataFrame, columns: list[str] | None = None, exact: bool = True, accuracy: int = 10_000
) -> DataFrame:
    """Rows ``count, null_count, mean, std, min, 25%, 50%, 75%, max`` per column.

    Numeric and boolean columns are described as doubles; dates and timestamps as text,
    with a mean and percentiles but no deviation; others as text with count, nulls,
    minimum and maximum. A percentile is the value nearest to that share of the way
    from the first to the last. The exact ones take some scans of their own, run when
    this is called (see ``exact_quantiles``); otherwise they come with the rest from a
    sketch of bounded size, with ranks off by up to ``rows / accuracy``.
    """
    columns = require_columns(df, columns or df.columns)
    numbers: dict[str, Column] = {}
    moments: dict[str, Column] = {}
    for c in columns:
        kind = type_of(df, c)
        if isinstance(kind, T.BooleanType):
            numbers[c] = ref(c).cast("int").cast("double")
        elif isinstance(kind, T.NumericType):
            numbers[c] = ref(c).cast("double")
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            moments[c] = _day_micros(ref(c))
    shares = {"25%": 0.25, "50%": 0.5, "75%": 0.75}
    found = exact_quantiles(df, numbers | moments, list(shares.values())) if exact else {}

    measures: dict[str, Column] = {}
    for c in columns:
        value = numbers.get(c, ref(c))
        measures |= {f"count {c}": F.count(value), f"null_count {c}": F.count_if(value.isNull())}
        measures |= {f"min {c}": F.min(value), f"max {c}": F.max(value)}
        if c in numbers or c in moments:
            scale = numbers.get(c, moments.get(c))
            measures[f"mean {c}"] = F.mean(scale)
            if c in numbers:
                measures[f"std {c}"] = F.stddev_samp(scale)
            if not exact:
                measures[f"percentiles {c}"] = F.percentile_approx(scale, list(shares.values()), accuracy)
    measured = in_parts(df, measures, 6 * _COLUMNS_PER_SCAN)

    def cell(statistic: str, c: str) -> Column:
        name = f"{statistic} {c}"
        if statistic in shares and (c in numbers or c in moments):
            i = list(shares).index(statistic)
            shown = F.lit(found[c][i]).cast("double") if exact else ref(f"percentiles {c}")[i]
        else:
            shown = ref(name) if name in measures else F.lit(None)
        if c in moments and (statistic in shares or statistic == "mean"):
            shown = _clock_text(shown)
        return shown.cast("double" if c in numbers else "string").alias(c)

    statistics = ["count", "null_count", "mean", "std", "min", *shares, "max"]
    rows = [
        F.struct(F.lit(i).alias("orden"), F.lit(s).alias("statistic"), *[cell(s, c) for c in columns])
        for i, s in enumerate(statistics)
    ]
    return measured.select(F.explode(F.array(*rows)).alias("row")).select("row.*")
