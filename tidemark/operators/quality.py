"""Rule-based data-quality report."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fixed
from ..functions import parse_timestamp, rate, two_decimals
from ..naming import ref, type_of
from .profile import in_parts

_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)
_COUNTERS_PER_SCAN = 40
_EPOCH = (T.LongType, T.IntegerType, T.DoubleType)
# In Java ``$`` also matches before a last line break, and word characters need a flag.
_EMAIL = "(?U)" + fixed.EMAIL_PATTERN.removesuffix("$") + r"\z"


@dataclass(frozen=True)
class _Check:
    """How one rule is counted and reported.

    ``counted`` marks the rows (or, for ``repeats``, nothing: rows beyond the first
    of each value are counted); ``failed`` and ``detail`` turn the counter and the
    number of rows into the verdict and its text.
    """

    detail: Callable[[Column, Column], Column]
    failed: Callable[[Column, Column], Column] = lambda n, total: n > 0
    counted: Column | None = None
    repeats: bool = False


def _counter(text: str, condition: Column) -> _Check:
    return _Check(lambda n, total: F.concat(n.cast("string"), F.lit(f" {text}")), counted=condition)


def _verdict(ok: bool, text: str) -> _Check:
    """A rule decided by the schema alone."""
    return _Check(lambda n, total: F.lit(text), failed=lambda n, total: F.lit(not ok))


def _not_null(df, name, options):
    return _counter(fixed.TEXT_NULLS, ref(name).isNull())


def _not_negative(df, name, options):
    _require(df, name, T.NumericType)
    return _counter(fixed.TEXT_NEGATIVE, ref(name) < 0)


def _email(df, name, options):
    return _counter(fixed.TEXT_EMAIL, ~ref(name).cast("string").rlike(_EMAIL))


def _no_repeats(df, name, options):
    return _Check(
        lambda n, total: F.concat(n.cast("string"), F.lit(f" {fixed.TEXT_DUPLICATES}")), repeats=True
    )


def _boolean(df, name, options):
    if isinstance(type_of(df, name), T.BooleanType):
        return _verdict(True, fixed.TEXT_BOOLEAN.format(name))
    return _verdict(False, fixed.TEXT_NOT_BOOLEAN)


def _date_format(df, name, options):
    kind = type_of(df, name)
    if isinstance(kind, _TEMPORAL):
        return _verdict(True, fixed.TEXT_DATE_TYPE.format(name, kind.simpleString()))
    if isinstance(kind, _EPOCH):
        return _verdict(True, fixed.TEXT_DATE_FROM_NUMBER.format(name))
    if isinstance(kind, T.StringType):
        if options["compat_dates"]:
            return _verdict(True, fixed.TEXT_DATE_FROM_TEXT.format(name))
        parsed = parse_timestamp(ref(name), options["date_formats"])
        return _counter("fechas no reconocidas", ref(name).isNotNull() & parsed.isNull())
    return _verdict(False, fixed.TEXT_NO_DATE_TYPE.format(kind.simpleString()))


def _not_future(df, name, options):
    kind = type_of(df, name)
    if isinstance(kind, T.StringType):
        date = parse_timestamp(ref(name), options["date_formats"]).cast("date")
    elif isinstance(kind, _EPOCH):
        # Days since 1970, whatever the session's time zone.
        date = F.date_add(F.lit(datetime.date(1970, 1, 1)), F.floor(ref(name) / 86400).cast("int"))
    else:
        _require(df, name, *_TEMPORAL)
        date = ref(name).cast("date")
    return _counter(fixed.TEXT_FUTURE, date > options["as_of"])


def _minimum_age(df, name, options):
    _require(df, name, T.NumericType)
    return _counter(fixed.TEXT_AGE.format(options["minimum_age"]), ref(name) < options["minimum_age"])


def _mostly_null(df, name, options):
    def share(n, total):
        return rate(n, total, when_empty=0.0) * 100.0

    def text(n, total):
        return F.concat(two_decimals(share(n, total)), F.lit(fixed.TEXT_NULL_SHARE))

    return _Check(text, lambda n, total: share(n, total) > fixed.NULL_SHARE_LIMIT, counted=ref(name).isNull())


def _require(df: DataFrame, name: str, *kinds: type) -> None:
    if not isinstance(type_of(df, name), kinds):
        raise ValueError(f"this rule does not apply to column {name!r} of type {type_of(df, name).simpleString()}")


# Rule names.
RULES = {
    "no_nulos": _not_null,
    "valores_positivos": _not_negative,
    "formato_email": _email,
    "no_duplicados": _no_repeats,
    "validacion_boolean": _boolean,
    "formato_fecha": _date_format,
    "fecha_no_futura": _not_future,
    "edad_mayor_18": _minimum_age,
    "nulos_mayor_95": _mostly_null,
}


def quality_report(
    df: DataFrame,
    rules: list[tuple[str, str]],
    as_of: datetime.date | None = None,
    minimum_age: int = fixed.MINIMUM_AGE,
    compat_dates: bool = False,
    date_formats: tuple[str, ...] | None = (fixed.DATE_FORMAT,),
) -> DataFrame:
    """One row per ``(column, rule)`` and a last row with the number of rows.

    Columns: ``orden`` (position of the rule), ``columna``, ``regla``, ``estado``
    and ``detalle``. Every rule reads the table as given. ``as_of`` is the day that
    ``fecha_no_futura`` compares with (today by default). Text is a date if one of the
    Java patterns ``date_formats`` reads it (with None, as in ``parse_timestamp``);
    ``compat_dates`` accepts any text as a date in ``formato_fecha``.

    All counters come from one aggregation that shuffles one row per task; beyond forty,
    from several, so that each stays small enough to be compiled. Only
    ``no_duplicados`` needs a shuffle of values; each such column is counted on its
    own, reading that column alone, so that its values do not drag the other
    counters through the shuffle as a multi-distinct aggregation would.
    """
    options = {
        "as_of": F.current_date() if as_of is None else F.lit(as_of),
        "minimum_age": minimum_age,
        "compat_dates": compat_dates,
        "date_formats": list(date_formats) if date_formats else None,
    }
    checks = [_check(df, column, rule, options) for column, rule in rules]

    counters = {f"n{i}": F.count_if(c.counted) for i, c in enumerate(checks) if c.counted is not None}
    counted = in_parts(df, {"total": F.count(F.lit(1))} | counters, _COUNTERS_PER_SCAN)
    rows = []
    for i, check in enumerate(checks):
        if not check.repeats:
            n = ref(f"n{i}") if check.counted is not None else F.lit(0)
            rows.append(_row(i, *rules[i], check.failed(n, ref("total")), check.detail(n, ref("total"))))
    total_text = F.concat(ref("total").cast("string"), F.lit(f" {fixed.TEXT_TOTAL}"))
    rows.append(_row(len(rules), fixed.REPORT_TOTAL, "", None, total_text))
    branches = [_rows(counted, rows)]

    repeated = sorted({rules[i][0] for i, c in enumerate(checks) if c.repeats})
    for column in repeated:
        per_value = df.groupBy(ref(column)).agg(F.count(F.lit(1)).alias("n"))
        repeats = per_value.agg(F.coalesce(F.sum(ref("n") - 1), F.lit(0)).alias("n"))
        rows = [
            _row(i, *rules[i], check.failed(ref("n"), None), check.detail(ref("n"), None))
            for i, check in enumerate(checks)
            if check.repeats and rules[i][0] == column
        ]
        branches.append(_rows(repeats, rows))
    return reduce(DataFrame.unionAll, branches)


def _check(df: DataFrame, column: str, rule: str, options: dict) -> _Check:
    if column not in df.columns:
        return _verdict(False, fixed.TEXT_NO_COLUMN)
    if rule not in RULES:
        return _verdict(False, fixed.TEXT_NO_RULE.format(rule))
    return RULES[rule](df, column, options)


def _row(position: int, column: str, rule: str, failed: Column | None, detail: Column) -> Column:
    state = F.lit("") if failed is None else F.when(failed, fixed.REPORT_FAILED).otherwise(fixed.REPORT_OK)
    return F.struct(
        F.lit(position).alias("orden"),
        F.lit(column).alias("columna"),
        F.lit(rule).alias("regla"),
        state.alias("estado"),
        detail.alias("detalle"),
    )


def _rows(counted: DataFrame, rows: list[Column]) -> DataFrame:
    return counted.select(F.explode(F.array(*rows)).alias("row")).select("row.*")
