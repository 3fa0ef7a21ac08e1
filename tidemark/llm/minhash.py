"""Near duplicates by one-permutation hashing.

One hash of every word shingle picks both a bin and a value; the least value of each bin is
the signature, and an empty bin takes the value of a bin that a universal hash leads it to
(optimal densification). Signatures are cut into bands; documents equal in a band share a
bucket. A bucket's candidate edges form a star around the member that shares most buckets
with others, so they are as many as its members, and every edge is confirmed on the full
sets. Where a bucket's members still lie in different components after that, the members
are compared in blocks, so that no link between two of them is lost.

Documents with the same set of shingles are one from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.shared import dealt_anew, keep, let_go, ship
from tidemark.session import BROADCAST_ROWS, has_at_most

#: Bins of a signature; bands of so many bins. At a similarity of 0.85 a pair shares no
#: bucket with a chance of about (1 - 0.85 ** 4) ** 32, 1 in 10 ** 10.
BINS, ROWS = 128, 4
#: Members of two blocks that one task compares at a time.
_BLOCK = 256
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """The set of word shingles as sorted 64-bit hashes.

    A-Z is lower-cased; words lie between ASCII white space. Fewer words than ``size``
    are one shingle; none, an empty set.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = min(size, len(words))
    total = np.full(len(words) - n + 1, n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            total = total * _ODD + hashes[k : len(words) - n + 1 + k]
    return np.unique(_mixed(total))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The densified one-permutation signature of a non-empty set of sorted hashes."""
    bits = np.uint64(64 - (BINS.bit_length() - 1))
    starts = np.searchsorted(hashes, np.arange(BINS, dtype=np.uint64) << bits)
    at = np.minimum(starts, len(hashes) - 1)
    values = hashes[at]
    full = (values >> bits) == np.arange(BINS, dtype=np.uint64)
    full &= starts < len(hashes)
    empty, begin, tries = np.flatnonzero(~full), 0, 16
    while len(empty):
        attempt = np.arange(begin, begin + tries, dtype=np.uint64)
        donors = (_mixed((empty.astype(np.uint64)[:, None] << np.uint64(32)) + attempt + np.uint64(1)) >> bits).astype(np.int64)
        hits = full[donors]
        done = hits.any(axis=1)
        values[empty[done]] = values[donors[done, hits[done].argmax(axis=1)]]
        empty, begin, tries = empty[~done], begin + tries, min(tries * 4, 1024)
    return values


def bands(hashes: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of the signature."""
    rows = signature(hashes).reshape(-1, ROWS)
    total = _mixed(np.arange(1, len(rows) + 1, dtype=np.uint64))
    with np.errstate(over="ignore"):
        for k in range(ROWS):
            total = total * _ODD + _mixed(rows[:, k])
    return _mixed(total).view(np.int64)


def _linked(common: int, a: int, b: int, percent: int) -> bool:
    return 100 * common >= percent * (a + b - common)


def _least_linkable(percent: int) -> int:
    """The smallest set that can be linked with one that differs: n of n + 1."""
    return 1 << 62 if percent >= 100 else -(-percent // (100 - percent))


def _described(df: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """``id, n_shingles, digest, bands`` of every row; no bands where only equal sets can be linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(text, size) for text in batch.column(1).to_pylist()]
            keys = [bands(x) if len(x) >= _least_linkable(percent) else np.empty(0, np.int64) for x in sets]
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column(0),
                    "n_shingles": pa.array([len(x) for x in sets], pa.int64()),
                    "digest": pa.array([xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets], pa.binary()),
                    "bands": pa.array(keys, pa.list_(pa.int64())),
                }
            )
        let_go()

    rows = df.selectExpr(f"cast(`{id_col}` as long) id", f"`{text_col}` text")
    return keep(rows.mapInArrow(run, "id long, n_shingles long, digest binary, bands array<long>"), "minhash-sets")


def _confirmed(edges: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The edges ``(a, hub)`` whose full sets are similar enough, as ``(a, b)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, of_hub = None, np.empty(0, np.uint64)
        for batch in batches:
            a, b = [], []
            columns = [batch.column(n).to_pylist() for n in ("a", "hub", "a_text", "hub_text")]
            for one, hub, one_text, hub_text in zip(*columns, strict=True):
                if last is None or last != (hub, hub_text):
                    last, of_hub = (hub, hub_text), shingles(hub_text, size)
                of_one = shingles(one_text, size)
                common = len(np.intersect1d(of_one, of_hub, assume_unique=True))
                if _linked(common, len(of_one), len(of_hub), percent):
                    a.append(one)
                    b.append(hub)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
        let_go()

    # Both joins can be split where a hub has many edges; rows come sorted by hub.
    rows = edges.join(texts.select(F.col("id").alias("a"), F.col("text").alias("a_text")), "a")
    rows = rows.join(texts.select(F.col("id").alias("hub"), F.col("text").alias("hub_text")), "hub")
    return rows.select("a", "hub", "a_text", "hub_text").mapInArrow(run, "a long, b long")


def _block_links(frame: pd.DataFrame, size: int, percent: int) -> list[tuple[int, int]]:
    """Links that join components among the members of one or two blocks."""
    ids, sets = frame["id"].tolist(), [shingles(t, size) for t in frame["text"]]
    root = {c: c for c in frame["component"]}

    def find(c):
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[order]
    values, found = values[order], []
    for k, (own, component) in enumerate(zip(sets, frame["component"], strict=True)):
        begins, ends = np.searchsorted(values, own), np.searchsorted(values, own, side="right")
        lengths = ends - begins
        at = np.repeat(begins - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        common = np.bincount(owners[at], minlength=len(sets))
        for other in np.flatnonzero(common[:k]):
            if find(frame["component"].iat[other]) != find(component) and _linked(
                int(common[other]), len(own), len(sets[other]), percent
            ):
                root[find(component)] = find(frame["component"].iat[other])
                found.append((ids[k], ids[other]))
    return found


def _rest(members: DataFrame, labels: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links inside buckets of three and more whose members lie in several components."""
    mark = F.xxhash64("id").cast("decimal(38,0)")
    named = members.join(labels.withColumnRenamed("node", "id"), "id", "left")
    named = named.select("bucket", "id", F.coalesce("component", "id").alias("component"))
    open_buckets = named.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("component").alias("least"),
        F.max("component").alias("most"),
        F.sum(mark).alias("sum"),
        F.sum(F.xxhash64("id", F.lit(1)).cast("decimal(38,0)")).alias("other_sum"),
    )
    # Buckets of different bands often have the same members: one of them will do.
    open_buckets = open_buckets.where("n > 2 and least < most").groupBy("n", "sum", "other_sum").agg(F.min("bucket").alias("bucket"))
    rows = keep(named.join(open_buckets.select("bucket", "n"), "bucket"), "minhash-open")
    n_blocks = F.ceil(F.col("n") / _BLOCK).cast("long")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id", F.lit(2)), n_blocks))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), n_blocks - 1)))
    rows = rows.select("bucket", "id", "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        found = pd.DataFrame(_block_links(frame, size, percent), columns=["a", "b"], dtype="int64")
        let_go()
        return found

    return rows.join(texts, "id").groupBy("bucket", "i", "j").applyInPandas(run, "a long, b long")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """Every row's group of near duplicates: ``id_col, n_shingles, component_id, kept``.

    Two documents are linked if 100 times their common shingles are at least ``percent``
    times those of either. The component is the smallest identifier that links lead to, its
    own included; the row of that identifier is kept. Null and empty texts, and those of
    white space, have no shingles and are linked with nothing. A row without identifier
    is linked with nothing either, has no component and is kept. Rows of one identifier
    count as one document. Identifiers are integers; further columns play no part; an
    empty table gives an empty result.
    """
    ship(df.sparkSession)
    rows = _described(df, id_col, text_col, size, percent)
    named = rows.where("digest is not null and id is not null")
    # The first document of each class, taken before rows are shuffled.
    first = named.groupBy("digest").agg(F.min(F.struct("id", "bands")).alias("first"))
    reps = keep(first.select("digest", F.col("first.id").alias("node"), F.col("first.bands").alias("bands")), "minhash-classes")

    buckets = reps.select(F.col("node").alias("id"), F.explode("bands").alias("bucket")).distinct()
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = keep(buckets.join(dealt_anew(sizes), "bucket"), "minhash-buckets")
    degrees = members.groupBy("id").agg(F.sum(F.col("n") - 1).alias("degree"))
    ranked = members.join(degrees, "id").select("bucket", "id", F.struct("degree", -F.col("id")).alias("rank"))
    hubs = ranked.groupBy("bucket").agg(F.max("rank").alias("rank"))
    hubs = hubs.select("bucket", (-F.col("rank.col2")).alias("hub"))
    edges = members.join(dealt_anew(hubs), "bucket").where("id != hub").select(F.col("id").alias("a"), "hub").distinct()
    edges = keep(edges, "minhash-candidates")

    wanted = edges.select("a").unionByName(edges.select(F.col("hub").alias("a"))).unionByName(
        members.where("n > 2").select(F.col("id").alias("a"))
    ).distinct()
    texts = df.selectExpr(f"cast(`{id_col}` as long) id", f"`{text_col}` text")
    texts = keep(texts.join(wanted.withColumnRenamed("a", "id"), "id", "left_semi"), "minhash-texts")
    links = keep(_confirmed(edges, texts, size, percent), "minhash-links")
    labels = keep(components(links), "minhash-components")
    more = keep(_rest(members, labels, texts, size, percent), "minhash-more-links")
    if not more.isEmpty():
        labels = keep(components(links.unionByName(more)), "minhash-components")

    found = reps.join(labels, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    result = rows.join(found, "digest", "left").withColumn(
        "component_id", F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    )
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))
    return result.select(F.col("id").alias(id_col), "n_shingles", "component_id", kept.alias("kept"))


def drop_near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """The rows of ``df`` that ``near_duplicates`` keeps, with all their columns."""
    found = near_duplicates(df, id_col, text_col, size, percent)
    dropped = found.where("not kept").select(F.col(id_col).cast("long").alias("dropped_id")).distinct()
    rows = df.select(F.struct("*").alias("row"), F.col(f"`{id_col}`").cast("long").alias("dropped_id"))
    # Identifiers only, broadcast if measured to be few.
    dropped = keep(dropped, "minhash-dropped")
    dropped = F.broadcast(dropped) if has_at_most(dropped, BROADCAST_ROWS) else dropped
    return rows.join(dropped, "dropped_id", "left_anti").select("row.*")
