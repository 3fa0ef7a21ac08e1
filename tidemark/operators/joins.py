"""Equi-joins and reference filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..naming import ref, require_columns, type_of

_TASK = "__task"

_HOW = {
    "inner": "inner",
    "left": "left",
    "right": "right",
    "outer": "full",
    "full": "full",
    "semi": "left_semi",
    "anti": "left_anti",
}


def merge(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str] | None = None,
    left_on: str | list[str] | None = None,
    right_on: str | list[str] | None = None,
    how: str = "inner",
    unique: str | None = None,
) -> DataFrame:
    """Join two tables on equal keys; null keys match nothing.

    One key column is kept (the left one; for ``right`` the right one), except for
    ``full``, which keeps both, the right one as ``<key>_right`` if the names are
    equal. Other name clashes get the suffix ``_right``.

    Adaptive execution splits a hot key of the preserved side of an outer join but
    not of the other side, and neither side of a full join. Outer joins are
    therefore written as the inner join, which splits on both sides, plus the rows
    without a partner, found against the collapsed keys of the other side. It splits
    only where both inputs are shuffled for the join: a side said to be unique is
    rebalanced first; write or rebalance any other table that was just grouped by the
    join's key before joining it to a skewed one.
    ``unique`` (``"left"``, ``"right"`` or ``"both"``) says which side is known to
    hold each key once; where that makes the plain outer join safe it is used, and
    the preserved side is read once instead of twice. Semi and anti joins then skip
    collapsing the copies of a key on the right. A wrong statement only costs time,
    not rows. Keys are of equal types or both whole numbers. The inputs must give the
    same rows each time they are read: write rows of ``read_api`` or ``first_rows`` first.
    """
    if how not in _HOW:
        raise ValueError(f"how={how!r} is not one of {sorted(_HOW)}")
    if unique not in (None, "left", "right", "both"):
        raise ValueError(f"unique={unique!r} is not 'left', 'right', 'both' or None")
    kind = _HOW[how]
    left_keys, right_keys = _keys(left, right, on, left_on, right_on)

    if kind in ("left_semi", "left_anti"):
        wanted = _keys_of(right, right_keys) if unique in ("right", "both") else _collapsed_keys(right, right_keys)
        return _match(left, left_keys, wanted, kind)

    dropped_left = set(left_keys) if kind == "right" else set()
    dropped_right = set(right_keys) if kind in ("inner", "left") else set()
    kept_left = [c for c in left.columns if c not in dropped_left]
    names = {
        c: f"{c}_right" if c in kept_left else c for c in right.columns if c not in dropped_right
    }
    output = kept_left + list(names.values())
    if len(set(output)) < len(output):
        raise ValueError(f"the join gives duplicate column names: {output}")

    joining = [f"__key{i}" for i in range(len(right_keys))]
    renamed = right.select(
        [ref(k).alias(j) for k, j in zip(right_keys, joining)]
        + [ref(c).alias(f"__right_{n}") for c, n in names.items()]
    )
    condition = reduce(
        lambda a, b: a & b, [ref(k) == ref(j) for k, j in zip(left_keys, joining)]
    )
    result = [ref(c) for c in kept_left] + [ref(f"__right_{n}").alias(n) for n in names.values()]

    plain = (
        kind == "inner"
        or unique == "both"
        or (kind == "left" and unique == "right")
        or (kind == "right" and unique == "left")
    )
    if plain:
        # A side that was grouped by the join's key keeps that partitioning, and then adaptive
        # execution does not split a hot key of the other side: deal it out anew.
        if unique in ("right", "both"):
            renamed = renamed.hint("rebalance")
        if unique in ("left", "both"):
            left = left.hint("rebalance")
        return left.join(renamed, condition, kind).select(result)

    parts = left.join(renamed, condition, "inner").select(result)
    if kind in ("left", "full"):
        alone = _match(left, left_keys, _collapsed_keys(right, right_keys), "left_anti")
        absent = [F.lit(None).cast(type_of(right, c)).alias(n) for c, n in names.items()]
        parts = parts.unionAll(alone.select([ref(c) for c in kept_left] + absent))
    if kind in ("right", "full"):
        alone = _match(right, right_keys, _collapsed_keys(left, left_keys), "left_anti")
        absent = [F.lit(None).cast(type_of(left, c)).alias(c) for c in kept_left]
        parts = parts.unionAll(alone.select(absent + [ref(c).alias(n) for c, n in names.items()]))
    return parts


def _keys(left, right, on, left_on, right_on) -> tuple[list[str], list[str]]:
    as_list = lambda v: [v] if isinstance(v, str) else list(v or [])
    if on:
        left_keys = right_keys = as_list(on)
    elif left_on and right_on:
        left_keys, right_keys = as_list(left_on), as_list(right_on)
    else:
        raise ValueError("give either on, or left_on and right_on")
    if len(left_keys) != len(right_keys):
        raise ValueError(f"{len(left_keys)} left keys but {len(right_keys)} right keys")
    require_columns(left, left_keys)
    require_columns(right, right_keys)
    for lk, rk in zip(left_keys, right_keys):
        lt, rt = type_of(left, lk), type_of(right, rk)
        # A whole number beyond 2**53 would match its rounded neighbours as a double.
        both_whole = isinstance(lt, T.IntegralType) and isinstance(rt, T.IntegralType)
        if lt != rt and not both_whole:
            raise TypeError(f"keys {lk!r} ({lt.simpleString()}) and {rk!r} ({rt.simpleString()}) do not compare")
    return left_keys, right_keys


def _keys_of(df: DataFrame, keys: list[str]) -> DataFrame:
    """The non-null key combinations under names that clash with nothing."""
    named = df.select([ref(k).alias(f"__match{i}") for i, k in enumerate(keys)])
    return named.filter(reduce(lambda a, b: a & b, [ref(c).isNotNull() for c in named.columns]))


def _collapsed_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The non-null key combinations, each once per input task.

    Copies of a hot key collapse before the first shuffle. A plain distinct would
    leave the keys partitioned as the join needs them, with its aggregation between
    shuffle and join, and then adaptive execution does not split hot keys of the
    other side either; this way the join shuffles the remaining keys itself.
    """
    keyed = _keys_of(df, keys)
    return keyed.withColumn(_TASK, F.spark_partition_id()).distinct().drop(_TASK)


def _match(df: DataFrame, keys: list[str], wanted: DataFrame, how: str) -> DataFrame:
    condition = reduce(
        lambda a, b: a & b, [ref(k) == ref(w) for k, w in zip(keys, wanted.columns)]
    )
    return df.join(wanted, condition, how)


def keep_referenced(
    df: DataFrame, references: list[tuple[str, DataFrame, str]], unique_keys: bool = False
) -> DataFrame:
    """Keep the rows whose foreign keys all exist in their reference tables.

    ``references`` lists ``(foreign key, reference table, primary key)``; put the
    small tables first, they are broadcast by Spark's own size check and cut the
    rows that a larger one has to shuffle. A hot foreign key is split by adaptive
    execution; null keys are dropped before any shuffle. ``unique_keys`` says that the
    primary keys are unique, so that their copies need not be collapsed first.

    Adaptive execution does not split the last join if the rows are then grouped by
    that same key: end with another one, or set
    ``spark.sql.adaptive.forceOptimizeSkewedJoin``.
    """
    if not references:
        raise ValueError("no reference table was given")
    unique = "right" if unique_keys else None
    for column, table, key in references:
        df = merge(df, table, left_on=column, right_on=key, how="semi", unique=unique)
    return df


def count_referenced(df: DataFrame, column: str, reference: DataFrame, key: str) -> DataFrame:
    """Number of rows whose key exists in a reference table, as one row ``rows``."""
    narrow = df.select(ref(column).alias("k"))
    return keep_referenced(narrow, [("k", reference, key)]).agg(F.count(F.lit(1)).alias("rows"))
