"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A document's features are the hashed character n-grams that it holds, each once. The
log-count ratio of a feature compares the shares of toxic and of other training documents
that hold it; these counts cover every labelled training row and are added up by Spark. A
logistic regression on the scaled features is then fitted on a sample of the labelled rows
that is bounded by ``fit_rows``. Scoring reads whole texts, one pass, and is linear.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import let_go, ship

#: Lengths of the n-grams, in characters.
LENGTHS = (3, 4, 5)
#: Hashed features.
BUCKETS = 1 << 18
#: Fixed value: an odd multiplier that spreads sums over 32 bits.
_SPREAD = np.uint32(2_654_435_761)
#: Features that a step of the regression takes in at a time.
_BLOCK = 1 << 19


def features(text: str | None, lengths: tuple[int, ...] = LENGTHS, buckets: int = BUCKETS) -> np.ndarray:
    """The sorted hashed n-grams of a lower-cased text between two spaces, each once."""
    chars = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    seen = np.zeros(buckets, bool)
    shift = np.uint32(32 - int(buckets).bit_length() + 1)
    mixed = (chars + np.uint32(1)) * _SPREAD
    value = np.full(len(chars), 0x811C9DC5, np.uint32)
    for n in range(1, min(max(lengths), len(chars)) + 1):
        # value[i]: a hash of the n characters from i on
        value = value[: len(chars) - n + 1]
        value *= np.uint32(0x01000193)
        value ^= mixed[n - 1 :]
        if n in lengths:
            seen[((value ^ (value >> np.uint32(15))) * _SPREAD) >> shift] = True
    return np.flatnonzero(seen)


@dataclass(frozen=True)
class Classifier:
    """A weight for each feature, its log-count ratio taken in, and a constant."""

    weights: np.ndarray
    constant: float
    lengths: tuple[int, ...] = LENGTHS

    def score(self, texts: list[str | None]) -> np.ndarray:
        sums = [self.weights[features(t, self.lengths, len(self.weights))].sum(dtype=np.float64) for t in texts]
        return 1 / (1 + np.exp(-np.clip(np.array(sums, np.float64) + self.constant, -500, 500)))


def _class_counts(labelled: DataFrame, lengths: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of either class in all, and those that hold each feature."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = np.zeros((2, buckets), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[label, features(text, lengths, buckets)] += 1
                rows[label] += 1
        let_go()
        at = np.flatnonzero(held.any(axis=0))
        yield pa.RecordBatch.from_pydict(
            {
                "feature": pa.array(np.concatenate([at, [-1]]), pa.int64()),
                "other": pa.array(np.concatenate([held[0, at], rows[:1]]), pa.int64()),
                "toxic": pa.array(np.concatenate([held[1, at], rows[1:]]), pa.int64()),
            }
        )

    schema = "feature long, other long, toxic long"
    sums = labelled.select("text", "label").mapInArrow(count, schema).groupBy("feature")
    # At most a row for each of the fixed number of features comes back.
    found = sums.agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")).toPandas()
    held = np.zeros((2, buckets + 1))
    held[:, found["feature"].to_numpy()] = found[["other", "toxic"]].to_numpy().T
    return held[:, -1], held[:, :-1]


def _logistic(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, steps: int, penalty: float):
    """Weights of a balanced logistic regression on rows scaled by ``ratio``.

    Adaptive steps that draw small weights to zero, so that the many n-grams which tell
    nothing add nothing to the sum of a long text. ``rows`` are emptied.
    """
    seen = np.zeros(len(ratio), bool)
    for row in rows:
        seen[row] = True
    used = np.flatnonzero(seen)
    scale, place = ratio[used], (np.cumsum(seen) - 1).astype(np.int32)
    blocks, first = [], 0
    while first < len(rows):
        # A step needs little memory beyond the features then. Rows are dropped as they are taken in.
        end, size = first, 0
        while end < len(rows) and (end == first or size + len(rows[end]) <= _BLOCK):
            end, size = end + 1, size + len(rows[end])
        sizes = np.array([len(x) for x in rows[first:end]])
        blocks.append((slice(first, end), sizes, place[np.concatenate(rows[first:end])]))
        rows[first:end] = [None] * (end - first)
        first = end
    balance = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))
    weights, past = np.zeros(len(used)), np.full(len(used), 1e-12)
    constant, past_constant = 0.0, 1e-12
    for _ in range(steps):
        slope, total, scaled = np.zeros(len(used)), 0.0, weights * scale
        for part, sizes, flat in blocks:
            owner = np.repeat(np.arange(len(sizes)), sizes)
            sums = np.bincount(owner, scaled[flat], len(sizes)) + constant
            error = balance[part] * (1 / (1 + np.exp(-np.clip(sums, -500, 500))) - labels[part])
            slope += np.bincount(flat, error[owner], len(used))
            total += error.sum()
        slope *= scale
        past += slope**2
        past_constant += total**2
        step = 0.1 / np.sqrt(past)
        weights -= step * slope
        weights = np.sign(weights) * np.maximum(np.abs(weights) - step * penalty, 0)
        constant -= 0.1 * total / np.sqrt(past_constant)
    full = np.zeros(len(ratio))
    full[used] = weights * scale
    return full, constant


def train(
    labelled: DataFrame,
    text_col: str = "text",
    label_col: str = "label",
    key_col: str = "key",
    fit_rows: int = 4_000,
    fit_features: int = 18_000_000,
    lengths: tuple[int, ...] = LENGTHS,
    buckets: int = BUCKETS,
    steps: int = 80,
    penalty: float = 6e-3,
) -> Classifier:
    """Fit the classifier on rows of text and label (1: toxic, 0: not).

    Rows whose label is neither 0 nor 1, or null, teach nothing; a null text counts as
    empty. The log-count ratios use every row. The regression uses the ``fit_rows / 2`` rows
    of either label whose ``key_col`` comes first in a hashed order: all of them if there
    are fewer. Of these, rows are left out that would bring the features of a label's rows
    beyond ``fit_features / 2``, but for its first one; ties in the order are taken as their texts come.
    Without rows of both labels every weight is zero, and the score is near 1 if
    all rows are toxic, else near 0.
    """
    ship(labelled.sparkSession)
    rows = labelled.select(
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.col(label_col).cast("int").alias("label"),
        F.md5(F.coalesce(F.col(key_col).cast("string"), F.lit(""))).alias("order"),
    ).where("label in (0, 1)")
    totals, held = _class_counts(rows, lengths, buckets)
    if not totals.all():
        return Classifier(np.zeros(buckets), 30.0 if totals[1] else -30.0, lengths)
    share = (held + 1) / (totals[:, None] + 2)
    ratio = np.log(share[1] / (1 - share[1])) - np.log(share[0] / (1 - share[0]))

    # A bound on the hashed order that leaves about twice the rows asked for, then the first of them.
    def sample(label: int) -> DataFrame:
        part = min(1.0, 2 * (fit_rows / 2 + 100) / totals[label])
        most = f"{min(int(part * 16**8), 16**8 - 1):08x}"
        chosen = rows.where((F.col("label") == label) & (F.substring("order", 1, 8) <= most))
        return chosen.orderBy("order", "text").limit(fit_rows // 2)

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, labels, taken = [], [], [0, 0]
        for frame in batches:
            for text, label in zip(frame["text"], frame["label"].tolist(), strict=True):
                row = features(text, lengths, buckets).astype(np.int32)
                if not taken[label] or taken[label] + len(row) <= fit_features // 2:
                    taken[label] += len(row)
                    found.append(row)
                    labels.append(label)
        if found:
            weights, constant = _logistic(found, np.array(labels, np.float64), ratio, steps, penalty)
            yield pd.DataFrame({"weights": [weights.tobytes()], "constant": [constant]})
        del found, labels
        let_go()

    one = sample(0).unionByName(sample(1)).select("text", "label").coalesce(1)
    (model,) = one.mapInPandas(fit, "weights binary, constant double").collect()
    return Classifier(np.frombuffer(bytes(model["weights"]), np.float64), model["constant"], lengths)


def score(df: DataFrame, model: Classifier, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``df`` with each text's score between 0 and 1 in ``score_col``; 0.5 and above is toxic.

    A null text is scored as an empty one. An input column of the name ``score_col`` is replaced.
    """
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # weights of a fixed number of features

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(texts.tolist()))

    return df.withColumn(score_col, of(F.col(text_col)))


def held_out(doc_id, folds: int = 5):
    """Whether a row is for testing: the checksum of its identifier's text leaves no rest."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))


def drop_toxic(df: DataFrame, model: Classifier, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``df`` whose text scores below ``threshold``; all columns stay as they are."""
    rows = score(df.select(F.struct("*").alias("row"), F.col(text_col).alias("text")), model, "text", "score")
    return rows.where(F.col("score") < threshold).select("row.*")
