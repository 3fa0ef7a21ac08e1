"""Exact quantiles of large columns by radix selection."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets that one scan tells values apart by: 12 of the 64 bits of a double's pattern.
STRETCHES = 4096
_SIGN = np.uint64(1 << 63)


@dataclass
class _Search:
    """A quantile's rank among the values of its column whose pattern begins with the bits of ``prefix``."""

    column: int
    rank: int
    prefix: int = 0


def nearest_rank(count: int, share: float) -> int:
    """1-based rank of the value nearest to a share of the way from first to last."""
    return math.floor((count - 1) * share + 0.5) + 1


def _patterns(values: np.ndarray) -> np.ndarray:
    """64-bit patterns in the order of the doubles: zeros are one, not-a-number comes last."""
    bits = np.where(np.isnan(values), np.nan, values + 0.0).view(np.uint64)
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def _double(pattern: int) -> float:
    bits = np.uint64(pattern)
    return float(np.array([bits ^ _SIGN if bits & _SIGN else ~bits], np.uint64).view(np.float64)[0])


def exact_quantiles(
    df: DataFrame, columns: dict[str, Column], shares: list[float], stretches: int = STRETCHES
) -> dict[str, list[float | None]]:
    """Per named double column, the values nearest to the given shares; null is left out.

    Radix selection: doubles are ordered by a 64-bit pattern. A scan counts, for all columns and
    searches at once, the values by the next bits of their patterns (``stretches``, a power of two, tells how
    many), among those that agree with a search in the bits before. With 12 bits a scan that
    is six scans at most, whatever the values; fewer if the values left to a search are
    all the same. Counts are reduced in the map tasks and by bucket; a row per search comes to
    the driver.
    """
    names, bits = list(columns), stretches.bit_length() - 1
    if stretches != 1 << bits or not 0 < bits <= 32:
        raise ValueError(f"{stretches} is not a power of two that fits")
    if not names:
        return {}
    found: dict[tuple[int, int], float] = {}
    searches: dict[tuple[int, int], _Search] = {}
    values = df.select([c.cast("double").alias(f"c{k}") for k, c in enumerate(columns.values())])
    done = 0
    while done < 64:
        width = min(bits, 64 - done)
        groups = sorted({(s.column, s.prefix) for s in searches.values()}) if done else [(k, 0) for k in range(len(names))]
        counted = _counted(values, groups, done, width)
        at = {group: k for k, group in enumerate(groups)}
        if done:
            wanted = [(k, i, at[s.column, s.prefix], float(s.rank)) for (k, i), s in searches.items()]
        else:
            # Ranks follow from the numbers of values, which the first scan finds.
            searches = {(k, i): _Search(k, 0) for k in range(len(names)) for i in range(len(shares))}
            wanted = [(k, i, k, share) for k in range(len(names)) for i, share in enumerate(shares)]
        hits = _hits(counted, wanted, by_share=not done).collect()
        # A column without values has no quantiles.
        searches = {key: searches[key] for key in {(r["column"], r["share"]) for r in hits}}
        for row in hits:
            search = searches[row["column"], row["share"]]
            search.rank = row["rank"] - row["before"]
            search.prefix = (search.prefix << width) | row["bucket"]
            if row["least"] == row["most"]:
                found[row["column"], row["share"]] = _double(row["least"] & ((1 << 64) - 1))
                del searches[row["column"], row["share"]]
        done += width
    return {name: [found.get((k, i)) for i in range(len(shares))] for k, name in enumerate(names)}


def _counted(values: DataFrame, groups: list[tuple[int, int]], done: int, width: int) -> DataFrame:
    """``place, bucket, n, least, most``: values of each group by the next ``width`` bits of their patterns.

    A group is a column and the first ``done`` bits; ``place`` is its place in the list.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            patterns: dict[int, np.ndarray] = {}
            for place, (column, prefix) in enumerate(groups):
                if column not in patterns:
                    patterns[column] = _patterns(batch.column(column).drop_null().to_numpy(zero_copy_only=False))
                inside = patterns[column]
                if done:
                    inside = inside[inside >> np.uint64(64 - done) == np.uint64(prefix)]
                if not len(inside):
                    continue
                bucket = ((inside >> np.uint64(64 - done - width)) & np.uint64((1 << width) - 1)).astype(np.int64)
                if place not in totals:
                    totals[place] = (
                        np.zeros(1 << width, np.int64),
                        np.full(1 << width, np.iinfo(np.uint64).max, np.uint64),
                        np.zeros(1 << width, np.uint64),
                    )
                n, least, most = totals[place]
                n += np.bincount(bucket, minlength=1 << width)
                np.minimum.at(least, bucket, inside)
                np.maximum.at(most, bucket, inside)
        for place, (n, least, most) in totals.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict(
                {
                    "place": pa.array(np.full(len(at), place, np.int32)),
                    "bucket": pa.array(at),
                    "n": pa.array(n[at]),
                    # Signed, in the same order.
                    "least": pa.array((least[at] ^ _SIGN).view(np.int64)),
                    "most": pa.array((most[at] ^ _SIGN).view(np.int64)),
                }
            )

    used = sorted({column for column, _ in groups})
    groups = [(used.index(column), prefix) for column, prefix in groups]
    rows = values.select([values.columns[k] for k in used]).mapInArrow(run, "place int, bucket long, n long, least long, most long")
    return rows.groupBy("place", "bucket").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))


def _hits(counted: DataFrame, wanted: list[tuple[int, int, int, float]], by_share: bool) -> DataFrame:
    """For each search ``(column, share, place, rank)`` the bucket that holds its rank; in place of the
    rank its share of the way from first to last may be given."""
    schema = "`column` int, share int, place int, wanted double"
    rows = F.broadcast(counted.sparkSession.createDataFrame(wanted, schema))
    of_place = Window.partitionBy("place")
    sums = counted.withColumns({"up_to": F.sum("n").over(of_place.orderBy("bucket")), "all": F.sum("n").over(of_place)})
    rank = F.floor((F.col("all") - 1) * F.col("wanted") + 0.5) + 1 if by_share else F.col("wanted").cast("long")
    hit = sums.join(rows, "place").withColumn("rank", rank).where("rank <= up_to and rank > up_to - n")
    unsigned = [F.col(c).bitwiseXOR(F.lit(-(1 << 63))).alias(c) for c in ("least", "most")]
    return hit.select("column", "share", "bucket", "rank", (F.col("up_to") - F.col("n")).alias("before"), *unsigned)
