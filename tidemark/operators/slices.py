"""Rows of a total order from one place to another, by selecting the keys at both places."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..naming import ref, require_columns

#: Rows that are sorted to find a place among them; a sample's rows, and its keys that are counted by.
SORTED_ROWS, SAMPLE_ROWS, SPLITTERS = 20_000, 4096, 16
_DIRECTION = re.compile(r"^(.*?)(?: (ASC|DESC) NULLS (FIRST|LAST))?$", re.DOTALL)


@dataclass(frozen=True)
class Key:
    """A column to sort by."""

    name: str
    descending: bool = False
    nulls_first: bool = True

    def order(self) -> Column:
        c = ref(self.name)
        if self.descending:
            return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()

    def before(self, value: Column, missing: bool) -> Column:
        """Whether a row's cell comes before ``value``, of which ``missing`` says whether it is null."""
        c = ref(self.name)
        if missing:
            return F.lit(False) if self.nulls_first else c.isNotNull()
        return F.coalesce(c > value if self.descending else c < value, F.lit(self.nulls_first))


def keys_of(df: DataFrame, order_by: list[str | Column]) -> list[Key] | None:
    """The columns and directions of an order; None if it has other expressions than columns."""
    keys = []
    for c in order_by:
        if isinstance(c, str):
            keys.append(Key(*require_columns(df, [c])))
            continue
        # A Column shows its name and, if it has one, its direction.
        shown = re.fullmatch(r"Column<'(.*)'>", str(c), re.DOTALL)
        name, direction, nulls = _DIRECTION.match(shown[1] if shown else "").groups()
        if name not in df.columns:
            return None
        keys.append(Key(name, direction == "DESC", nulls != "LAST"))
    simple = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)
    return keys if all(isinstance(df.schema[k.name].dataType, simple) for k in keys) else None


class Order:
    """A total order of a table's rows by key columns."""

    def __init__(self, df: DataFrame, keys: list[Key]):
        self.keys, self.types = keys, {k.name: df.schema[k.name].dataType for k in keys}
        self.df = df.select([ref(k.name) for k in keys])
        self.columns = [k.order() for k in keys]

    def before(self, at: Row | None, nothing: bool) -> Column:
        """Whether a row comes before the one with the key ``at``; without a key it does if ``nothing``."""
        if at is None:
            return F.lit(nothing)
        found, equal = [], []
        for key, cell in zip(self.keys, at, strict=True):
            value = F.lit(cell).cast(self.types[key.name])
            found.append(reduce(Column.__and__, equal, key.before(value, cell is None)))
            equal.append(ref(key.name).eqNullSafe(value))
        return reduce(Column.__or__, found)

    def between(self, low: Row | None, high: Row | None) -> Column:
        """Whether a row is ``low`` or comes after it, and comes before ``high``."""
        return ~self.before(low, False) & self.before(high, True)


@dataclass
class _Search:
    """The key of place ``at``: not before ``low``, which has ``below`` rows before it, and before ``high``,
    which has ``above`` of them."""

    at: int
    below: int
    above: int
    low: Row | None = None
    high: Row | None = None
    found: Row | None = None
    candidates: list[Row] = field(default_factory=list)

    def narrow(self, key: Row, before: int) -> None:
        if self.below <= before <= self.at:
            self.low, self.below = key, before
        elif self.at < before < self.above:
            self.high, self.above = key, before


def keys_at(order: Order, places: list[int], rows: int) -> list[Row]:
    """The keys at some places (from 0, below ``rows``) of the order.

    Each round takes a sample of at most some thousand keys of what is left to a search, counts the
    rows before those of them that lie around the place, all searches in one scan, and goes on
    between the two that enclose it: about a thousandth of the rows, or fewer. Some ten
    thousand are sorted at last. No task holds the rows before a place.
    """
    searches = [_Search(p, 0, rows) for p in places]
    while todo := [s for s in searches if s.found is None]:
        for search in todo:
            left = order.df.where(order.between(search.low, search.high))
            n = search.above - search.below
            if n <= SORTED_ROWS:
                search.found = left.orderBy(*order.columns).offset(search.at - search.below).limit(1).first()
                if search.found is None:
                    raise ValueError("the rows changed while places were looked for")
                continue
            sample = left.sample(min(1.0, SAMPLE_ROWS / n), seed=search.at).limit(4 * SAMPLE_ROWS)
            drawn = sample.orderBy(*order.columns).collect()
            # A sample's place is off by its root at most, nearly always.
            near, step = (search.at - search.below) * len(drawn) // n, 1 + math.isqrt(len(drawn)) * 3 // SPLITTERS
            at = {near + k * step for k in range(-SPLITTERS // 2, SPLITTERS // 2 + 1)}
            search.candidates = [drawn[k] for k in sorted(at) if 0 <= k < len(drawn)]
        todo = [s for s in todo if s.found is None]
        counted = [(s, key) for s in todo for key in s.candidates]
        if not counted:
            continue
        sizes = [s.above - s.below for s in todo]
        first, last = min(todo, key=lambda s: s.below), max(todo, key=lambda s: s.above)
        counts = [F.count_if(order.before(key, True)).alias(str(k)) for k, (_, key) in enumerate(counted)]
        found = order.df.where(order.between(first.low, last.high)).agg(*counts).first()
        below = first.below
        for (search, key), n in zip(counted, found, strict=True):
            search.narrow(key, below + n)
        if any(s.above - s.below >= n for s, n in zip(todo, sizes, strict=True)):
            raise ValueError("order_by is no total order: too many rows are equal in it")
    return [s.found for s in searches]
