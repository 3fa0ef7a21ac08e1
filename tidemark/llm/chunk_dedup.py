"""Substring duplicates by content-defined chunking.

A gear rolling hash over the bytes of a text marks where chunks end, so a passage is cut
alike wherever it stands: an insertion moves the cuts near it only. Chunks are compared
by digest over all documents; the first of equal chunks, in the order of identifiers and
positions, stays. Chunks are far smaller than the passages to be found, so that several fall
into each; ``least_run`` lets only longer runs of them go, so that phrases which just recur stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import dealt_anew, keep, packed_texts, ship

#: Bytes that the 32-bit gear hash looks back on.
WINDOW = 16


@dataclass(frozen=True)
class Cuts:
    """Sizes of chunks in bytes: at least ``least`` (not below the hash's window), at most
    ``most``; between them a chunk ends with a chance of 1 in ``2 ** bits`` per character."""

    least: int = 16
    most: int = 512
    bits: int = 4

    def __post_init__(self):
        if not WINDOW <= self.least <= self.most - 4:
            raise ValueError(f"chunk sizes need {WINDOW} <= least <= most - 4")


def _gear() -> np.ndarray:
    """A random 32-bit value for every byte, from a rule: scrambled multiples of an odd number."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(32)).astype(np.uint32)


_GEAR = _gear()


def cut_points(data: bytes, cuts: Cuts) -> list[int]:
    """Where the chunks of ``data``, UTF-8 text, end; characters stay whole."""
    size = len(data)
    if not size:
        return []
    raw = np.frombuffer(data, np.uint8)
    # rolled[i] = sum of gear[byte i - j] << j over the last WINDOW bytes, by doubling.
    rolled, step = _GEAR[raw], 1
    while step < min(WINDOW, size):
        longer = rolled.copy()
        longer[step:] += rolled[:-step] << np.uint32(step)
        rolled, step = longer, 2 * step
    ends = np.flatnonzero((rolled >> np.uint32(32 - cuts.bits)) == 0) + 1
    inside = ends < size
    ends = ends[inside]
    # A chunk may not end before a continuation byte: then it ends after the character.
    starts = (raw & 0xC0) != 0x80
    following = np.concatenate([np.flatnonzero(starts), [size]])
    ends = following[np.searchsorted(following, ends)]
    found, begin = [], 0
    candidates, k = ends.tolist(), 0
    while begin < size:
        while k < len(candidates) and candidates[k] < begin + cuts.least:
            k += 1
        most = begin + cuts.most
        end = candidates[k] if k < len(candidates) else size
        if end > most:
            end = most
            while end < size and not starts[end]:
                end -= 1
            end = min(end, size)
        found.append(min(end, size))
        begin = found[-1]
    return found


def chunks(df: DataFrame, cuts: Cuts = Cuts(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The chunks of every text: ``id, at, size, digest``; none of null and empty texts."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at, sizes, digests = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = (text or "").encode()
                begin = 0
                for end in cut_points(data, cuts):
                    ids.append(doc)
                    at.append(begin)
                    sizes.append(end - begin)
                    digests.append(xxhash.xxh3_128_digest(data[begin:end]))
                    begin = end
            yield pa.RecordBatch.from_pydict(
                {
                    "id": pa.array(ids, pa.int64()),
                    "at": pa.array(at, pa.int32()),
                    "size": pa.array(sizes, pa.int32()),
                    "digest": pa.array(digests, pa.binary()),
                }
            )

    rows = df.selectExpr(f"cast(`{id_col}` as long) id", f"`{text_col}` text").where("id is not null")
    return rows.mapInArrow(run, "id long, at int, size int, digest binary")


def _removed(table: DataFrame) -> DataFrame:
    """``id, spans`` of documents with repeated chunks; a span is (at, size, document that has it first)."""
    # The minima are taken before rows are shuffled; the join can be split where a chunk is common.
    first = table.groupBy("digest").agg(F.min(F.struct("id", "at")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = table.join(dealt_anew(first.select("digest", "first")), "digest").where(F.struct("id", "at") != F.col("first"))
    return later.groupBy("id").agg(F.collect_list(F.struct("at", "size", F.col("first.id").alias("first"))).alias("spans"))


def runs(ends: list[int], repeated: set[tuple[int, int]], least: int) -> list[tuple[int, int]]:
    """First chunk and chunk after the last, counted from 0, of the runs to drop: adjacent repeated
    chunks of ``least`` bytes together, or all there are."""
    found, first, begin, start = [], 0, 0, 0
    for k, end in enumerate([*ends, None]):
        if end is None or (begin, end - begin) not in repeated:
            if k > first and (begin - start >= least or k - first == len(ends)):
                found.append((first, k))
            first, start = k + 1, end
        begin = end
    return found


def drop_chunks(
    df: DataFrame, cuts: Cuts = Cuts(), id_col: str = "doc_id", text_col: str = "text", least_run: int = 0
) -> DataFrame:
    """Every row without the runs of chunks that stand in an earlier place too:
    ``id_col, n_chunks, n_dropped, n_bytes, n_removed, first_docs`` (the other documents in
    which its dropped chunks stand first), ``text`` (what is left).

    Places are ordered by identifier, then position, so repeats within a document go
    too. Adjacent repeated chunks are dropped if they have ``least_run`` bytes together or are the
    whole text, wherever each of them stands first. Chunks are equal if their 128-bit digests are. Null and empty texts have no
    chunks and stay empty. A row without identifier is left as it is and takes no part. Rows
    of one identifier count as one document whose chunks are all dropped or kept by
    position. A document's spans are gathered in one row, no more than its text. Further
    columns play no part; an empty table gives an empty result.
    """
    # Cut twice rather than written between: the digests would be the largest of all files.
    removed = keep(_removed(chunks(df, cuts, id_col, text_col)), "chunks-removed")
    rows = df.selectExpr(f"cast(`{id_col}` as long) id", f"coalesce(`{text_col}`, '') text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out = {"first_docs": [], "n_chunks": [], "n_dropped": [], "n_bytes": [], "n_removed": [], "text": []}
            columns = [batch.column(n).to_pylist() for n in ("id", "packed", "spans")]
            for one, packed, spans in zip(*columns, strict=True):
                data, begin, parts, dropped = unpack.decompress(packed), 0, [], 0
                gone = {(s["at"], s["size"]): s["first"] for s in spans or ()}
                ends, firsts = cut_points(data, cuts), set()
                bounds = [0, *ends]
                for first, after in runs(ends, gone.keys(), least_run):
                    parts.append(data[begin : bounds[first]])
                    begin, dropped = bounds[after], dropped + after - first
                    firsts |= {gone[a, b - a] for a, b in zip(bounds[first:after], bounds[first + 1 : after + 1], strict=True)}
                parts.append(data[begin:])
                left = b"".join(parts)
                for name, value in (
                    ("n_chunks", len(ends)),
                    ("n_dropped", dropped),
                    ("n_bytes", len(data)),
                    ("n_removed", len(data) - len(left)),
                    ("text", left.decode()),
                    ("first_docs", sorted(firsts - {one})),
                ):
                    out[name].append(value)
            kinds = {"text": pa.string(), "first_docs": pa.list_(pa.int64())}
            yield pa.RecordBatch.from_pydict(
                {id_col: batch.column("id")} | {n: pa.array(v, kinds.get(n, pa.int64())) for n, v in out.items()}
            )

    joined = packed_texts(rows).join(removed, "id", "left").select("id", "packed", "spans")
    schema = f"`{id_col}` long, first_docs array<long>, n_chunks long, n_dropped long, n_bytes long, n_removed long, text string"
    return joined.mapInArrow(cut, schema)
