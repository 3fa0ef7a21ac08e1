"""Exact repeated substrings across documents, by fingerprints and sharded suffix arrays.

Every 50-byte string holds at least one selected 20-byte gram: one whose hash is least
among the grams of some such string (winnowing). So two equal strings select the same grams,
and all that a repeat can be found in are the contexts of grams that several documents
select: the up to 80 bytes of the 50-byte strings around a gram.

1. Tasks select grams and send, packed by ranges of the gram's hash, the hash, the
   context's digest and the place. Contexts that repeat within a task are settled there, and
   their places sent beside the ranges.
2. Per range, a context that stands in an earlier document too is covered whole. Only the
   first places of contexts whose gram has other contexts as well are left. Grams too frequent
   for a range, known from a sample of documents, go as rows: minima taken before the shuffle and
   a join that can be split find the first places of their contexts.
3. These contexts are dealt by gram into shards. Of those that share 40 bytes around the gram with
   another document, as any that share 50 do, each shard gets a suffix array, and the lengths of
   common prefixes tell which 50-byte strings are equal.
4. The covered bytes are cut out of the texts.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import dealt_anew, keep, let_go, packed_texts, ship
from tidemark.llm.suffix_array import PART_END, common_prefixes, suffix_array

#: Bytes of a repeat, and of a gram.
LENGTH, GRAM = 50, 20
#: Text that a task works on at a time, selected grams of a range, contexts of a shard, and
#: contexts of one gram beyond which its strings are compared by digest instead.
_TEXT, _RANGE, _SHARD, _CROWDED = 1 << 23, 400_000, 20_000, 65_536
_DIGEST_BITS = 48
#: Places from which on a gram stays out of the ranges, as counted in one document of so many.
_HOT, _SAMPLE = 65_536, 16
#: Texts of a batch: Spark sends up to 10,000 at a time, and what a task makes of them would be held as well.
_TEXTS = 512
#: Bytes of texts whose grams are hashed together: arrays of that many numbers stay in the processor's cache.
_JOINED = 1 << 17


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of ``_TEXTS`` rows at most."""
    for batch in batches:
        for at in range(0, batch.num_rows, _TEXTS):
            yield batch.slice(at, _TEXTS)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        return x


_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64))
_BASE = 0x9E3779B97F4A7C15


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """A polynomial hash of every gram, by doubling."""
    with np.errstate(over="ignore"):
        doubled, length, total, covered = np.take(_BYTES, data), 1, None, 0
        while True:
            if size & length:
                if total is None:
                    total = doubled
                else:
                    n = len(data) - covered - length + 1
                    total = total[:n] * np.uint64(pow(_BASE, length, 1 << 64))
                    total += doubled[covered : covered + n]
                covered += length
            if covered == size:
                return _mixed(total)
            following = doubled[length:]
            doubled = doubled[:-length] * np.uint64(pow(_BASE, length, 1 << 64))
            doubled += following
            length *= 2


def _running(values: np.ndarray, width: int, pick) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values, size = pick(values[:-size], values[size:]), 2 * size
    return pick(values[: len(values) - (width - size)], values[width - size :]) if size < width else values


def select(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the selected grams: the number of the text, the place in it, hash and context digest; none of short texts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    if len(raw) < length:
        return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.uint64), np.empty(0, np.uint64)
    hashes, width = _grams(raw, gram), length - gram + 1
    edge = np.zeros(width - 1, np.uint64)
    least = np.concatenate([edge, _running(hashes, width, np.minimum), edge])
    # Strings that cross from one text to the next select nothing.
    across = (ends[:-1, None] - np.arange(1, length)).ravel()
    least[across[(across >= 0) & (across <= len(raw) - length)] + width - 1] = 0
    at = np.flatnonzero(hashes == _running(least, width, np.maximum))
    text = np.searchsorted(ends, at, side="right")
    inside = (at + gram <= ends[text]) & (sizes[text] >= length)
    at, text = at[inside], text[inside]
    start = ends[text] - sizes[text]
    begin, end = np.maximum(at - (length - gram), start), np.minimum(at + length, ends[text])
    # Grams that overlap cover a context, so their hashes and its shape make its digest.
    digest = _mixed((at - begin).astype(np.uint64) * np.uint64(1 << 20) + (end - begin).astype(np.uint64))
    with np.errstate(over="ignore"):
        for shift in (0, gram, 2 * gram, 2 * length):
            digest = _mixed(digest * np.uint64(_BASE) + hashes[np.minimum(begin + shift, end - gram)])
    return text, (at - start).astype(np.int32), hashes[at], digest >> np.uint64(64 - _DIGEST_BITS)


def _joined(texts: Iterator[tuple[int, str]]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Identifiers and bytes of neighbouring texts, ``_JOINED`` bytes or one text at a time."""
    ids: list[int] = []
    found: list[bytes] = []
    size = 0
    for one, text in texts:
        ids.append(one)
        found.append(text.encode())
        size += len(found[-1])
        if size >= _JOINED:
            yield ids, found
            ids, found, size = [], [], 0
    if ids:
        yield ids, found


def _planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each value, all first bytes first: these compress best."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _values(data: bytes, width: int, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, n).T
    return out.view("<u8").ravel()


def _pack(docs: np.ndarray, key: np.ndarray, digest: np.ndarray, doc: np.ndarray, at: np.ndarray, settled: np.ndarray) -> bytes:
    """Entries sorted by key, then those settled in their task already."""
    used, doc = np.unique(doc, return_inverse=True)
    order = np.argsort(settled, kind="stable")
    n_open = len(settled) - int(settled.sum())
    opened = order[:n_open]
    parts = [
        _planes(np.diff(docs[used].view(np.uint64), prepend=np.uint64(0)), 8),
        _planes(np.diff(key[opened], prepend=np.uint64(0)), 8),
        _planes(digest[opened], _DIGEST_BITS // 8),
        _planes(doc[order], 4),
        _planes(at[order], 4),
    ]
    body = zstandard.ZstdCompressor(level=1).compress(b"".join(parts))
    return struct.pack("<III", len(used), n_open, len(order)) + body


def _unpack(blob: bytes) -> tuple[np.ndarray, ...]:
    """key, digest, document and place of the open entries; document and place of the settled."""
    n_docs, n_open, n = struct.unpack("<III", blob[:12])
    body, parts, at = zstandard.ZstdDecompressor().decompress(blob[12:]), [], 0
    for width, size in ((8, n_docs), (8, n_open), (_DIGEST_BITS // 8, n_open), (4, n), (4, n)):
        parts.append(_values(body[at : at + width * size], width, size))
        at += width * size
    docs = np.cumsum(parts[0], dtype=np.uint64).view(np.int64)
    doc, place = docs[parts[3].astype(np.int64)], parts[4].astype(np.int32)
    return np.cumsum(parts[1], dtype=np.uint64), parts[2], doc[:n_open], place[:n_open], doc[n_open:], place[n_open:]


def _first_of_group(*keys: np.ndarray) -> np.ndarray:
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def _settle(key: np.ndarray, digest: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key, context, document; in that order, starts of contexts and whether an
    earlier document has the context too."""
    order = np.argsort(key)
    # Most keys are there once; only the others are sorted on.
    new = _first_of_group(key[order])
    tied = np.flatnonzero(~(new & np.append(new[1:], True)[: len(new)]))
    again = order[tied]
    order[tied] = again[np.lexsort((doc[again], digest[again], key[again]))]
    key, digest, doc = key[order], digest[order], doc[order]
    first = _first_of_group(key, digest)
    least = doc[np.flatnonzero(first)][np.cumsum(first) - 1] if len(doc) else doc
    return order, first, doc > least


def _hot(rows: DataFrame, grams: int, key_bits: int, length: int, gram: int) -> np.ndarray:
    """Keys of frequent grams, sorted; about 4 million at most. Any choice gives the same result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            for _, texts in _joined((0, text) for text in batch.column(0).to_pylist()):
                key = select(texts, length, gram)[2] >> np.uint64(64 - key_bits)
                yield pa.RecordBatch.from_pydict({"key": pa.array(key.view(np.int64), pa.int64())})

    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(_SAMPLE)) == 0).select("text")
    counts = sample.mapInArrow(run, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    found = counts.where(F.col("n") >= max(1, max(_HOT, grams >> 22) // _SAMPLE)).select("key").collect()
    return np.sort(np.array([r["key"] for r in found], np.int64).view(np.uint64))


def _among(key: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(key), bool)
    return hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] == key


def _bounds(ranges: int, key_bits: int, reach: int) -> np.ndarray:
    """Where ranges of the key begin that hold alike many selected grams.

    A gram of hash x, as a share of all hashes, is selected if ``reach`` neighbours in a row have
    greater ones: with a chance of ``(1 - x)**reach * (1 + reach * x)``, so small hashes stand out.
    """

    def beyond(x: np.ndarray) -> np.ndarray:
        return (1 - x) ** (reach + 1) * ((reach + 2) - reach * (1 - x)) / 2

    share = np.arange(ranges) / ranges
    low, high = np.zeros(ranges), np.ones(ranges)
    for _ in range(60):
        middle = (low + high) / 2
        before = 1 - beyond(middle) <= share
        low, high = np.where(before, middle, low), np.where(before, high, middle)
    low[0] = 0
    return np.ceil(low * 2.0**key_bits).astype(np.uint64)


def _selected(rows: DataFrame, ranges: int, key_bits: int, length: int, gram: int, hot: np.ndarray) -> DataFrame:
    """``range, blob``: the selected places, of which texts are gone through once.

    Settled places are in as many ranges beyond the last, spread by task, and open places of hot
    grams in one beyond these, which no task takes whole.
    """
    begins = _bounds(ranges, key_bits, length - gram)

    def packed(number: int, blob: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"range": pa.array([number], pa.int32()), "blob": pa.array([blob], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        waiting: list[tuple[np.ndarray, ...]] = []
        size = flushed = 0
        task = TaskContext.get().partitionId()

        def flush() -> Iterator[pa.RecordBatch]:
            doc, at, hashes, digest = (np.concatenate([x[k] for x in waiting]) for k in range(4))
            docs, number = np.unique(np.array(ids, np.int64), return_inverse=True)
            doc, key = number[doc], hashes >> np.uint64(64 - key_bits)
            order, _, settled = _settle(key, digest, docs[doc])
            key, digest, doc, at = key[order], digest[order], doc[order], at[order]
            apart = _among(key, hot)
            part = apart & ~settled
            if part.any():
                yield packed(2 * ranges, _pack(docs, key[part], digest[part], doc[part], at[part], settled[part]))
            if settled.any():
                blob = _pack(docs, key[settled], digest[settled], doc[settled], at[settled], settled[settled])
                yield packed(ranges + int(_mixed(np.array([task << 32 | flushed], np.uint64))[0] % np.uint64(ranges)), blob)
            in_range = ~settled & ~apart
            key, digest, doc, at = key[in_range], digest[in_range], doc[in_range], at[in_range]
            settled = np.zeros(len(key), bool)
            # Ranges of the key, which is sorted.
            cuts = np.append(np.searchsorted(key, begins), len(key)).tolist()
            for k in range(ranges):
                part = slice(cuts[k], cuts[k + 1])
                if cuts[k] < cuts[k + 1]:
                    yield packed(k, _pack(docs, key[part], digest[part], doc[part], at[part], settled[part]))

        for batch in _parts(batches):
            for some, texts in _joined(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                text, *found = select(texts, length, gram)
                waiting.append((text + len(ids), *found))
                ids += some
                size += sum(map(len, texts))
                if size >= _TEXT:
                    yield from flush()
                    ids, waiting, size, flushed = [], [], 0, flushed + 1
        if waiting:
            yield from flush()
        waiting.clear()
        let_go()

    selected = keep(rows.mapInArrow(run, "range int, blob binary"), "repeats-selected")
    # Conditions on the range would leave a row without one out, and its places with it.
    number = F.coalesce("range", F.raise_error(F.lit("selected places without a range")))
    return selected.select(number.alias("range"), "blob")


def _unpacked(blobs: DataFrame) -> DataFrame:
    """``key, digest, id, at``: the open places as rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                key, digest, doc, at, *_ = _unpack(blob)
                columns = {"key": key.view(np.int64), "digest": digest.view(np.int64), "id": doc, "at": at}
                yield pa.RecordBatch.from_pydict({n: pa.array(v) for n, v in columns.items()})
        let_go()

    return blobs.select("blob").mapInArrow(run, "key long, digest long, id long, at int")


def _settled_hot(table: DataFrame) -> DataFrame:
    """As ``_settled``, of the rows of hot grams; all of their first places are left open."""
    # The minima are taken before rows are shuffled; the join can be split where a context is common.
    least = table.groupBy("key", "digest").agg(F.min("id").alias("least"))
    found = table.join(dealt_anew(least), ["key", "digest"])
    return found.select("id", "at", F.when(F.col("id") == F.col("least"), F.col("key")).alias("key"))


def _settled(frame: pd.DataFrame) -> pd.DataFrame:
    """Of one range: places that are covered (without key), and first places left open."""
    parts = list(zip(*[_unpack(b) for b in frame["blob"]], strict=True))
    key, digest, doc, at, settled_doc, settled_at = (np.concatenate(p) for p in parts)
    order, first, later = _settle(key, digest, doc)
    key, doc, at = key[order], doc[order], at[order]
    # Grams with two contexts and more.
    of_key = np.cumsum(_first_of_group(key)) - 1
    several = np.bincount(of_key, first) > 1 if len(key) else np.zeros(0, bool)
    left = several[of_key] & ~later if len(key) else later
    ids = np.concatenate([settled_doc, doc[later], doc[left]])
    found = pd.DataFrame({"id": ids, "at": np.concatenate([settled_at, at[later], at[left]])})
    covered = len(settled_doc) + int(later.sum())
    found["key"] = pd.array(np.concatenate([np.zeros(covered, np.int64), key[left].view(np.int64)]), "Int64")
    found.loc[: covered - 1, "key"] = pd.NA
    let_go()
    return found


def _contexts(rows: DataFrame, places: DataFrame, length: int, gram: int) -> DataFrame:
    """``key, id, begin, gram, context`` of the places left open; ``gram`` is its gram's place in a context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in _parts(batches):
            out: dict[str, list] = {"key": [], "id": [], "begin": [], "gram": [], "context": []}
            columns = [batch.column(n).to_pylist() for n in ("id", "packed", "at", "key")]
            for one, packed, places_at, keys in zip(*columns, strict=True):
                data = unpack.decompress(packed)
                for at, key in zip(places_at, keys, strict=True):
                    begin, end = max(at - (length - gram), 0), min(at + length, len(data))
                    if end - begin >= length:
                        out["key"].append(key)
                        out["id"].append(one)
                        out["begin"].append(begin)
                        out["gram"].append(at - begin)
                        out["context"].append(data[begin:end])
            kinds = {"key": pa.int64(), "id": pa.int64(), "begin": pa.int32(), "gram": pa.int32(), "context": pa.binary()}
            yield pa.RecordBatch.from_pydict({n: pa.array(v, kinds[n]) for n, v in out.items()})
        let_go()

    by_doc = places.groupBy("id").agg(F.collect_list(F.struct("at", "key")).alias("p"))
    by_doc = by_doc.select("id", F.col("p.at").alias("at"), F.col("p.key").alias("key"))
    joined = packed_texts(rows).join(by_doc, "id").select("id", "packed", "at", "key")
    return joined.mapInArrow(run, "key long, id long, begin int, gram int, context binary")


def may_repeat(
    contexts: list[bytes], key: np.ndarray, at: np.ndarray, docs: np.ndarray, length: int = LENGTH, gram: int = GRAM
) -> np.ndarray:
    """Which contexts have bytes around their gram in common with a context of the same gram in another document.

    A string of ``length`` bytes reaches over its gram by ``length - gram`` bytes in all. However they are
    divided between both sides, it holds one of three strings that reach over by two thirds of that, so
    contexts that share none of these have no string of ``length`` bytes in common through the gram.
    """
    sizes = np.array([len(c) for c in contexts], np.int64)
    # Behind the last context are zeros to read whole words from.
    raw = np.frombuffer(b"".join(contexts) + bytes(length + 8), np.uint8)
    begins = np.cumsum(sizes) - sizes
    room = length - gram
    step = -(-room // 3)
    size = length - step
    found = np.zeros(len(contexts), bool)
    for left in {*range(0, room - step, max(step, 1)), room - step}:
        whole = np.flatnonzero((at >= left) & (at - left + size <= sizes))
        if not len(whole):
            continue
        strings = np.zeros((len(whole), -(-size // 8) * 8), np.uint8)
        strings[:, :size] = raw[(begins + at - left)[whole, None] + np.arange(size)]
        value = _mixed(key[whole].view(np.uint64))
        with np.errstate(over="ignore"):
            for word in strings.view("<u8").T:
                value = _mixed(value * np.uint64(_BASE) + word)
        order = np.argsort(value)
        new = _first_of_group(value[order])
        groups, doc = np.flatnonzero(new), docs[whole][order]
        shared = np.minimum.reduceat(doc, groups) < np.maximum.reduceat(doc, groups)
        found[whole[order]] |= shared[np.cumsum(new) - 1]
    return found


def repeats(contexts: list[bytes], docs: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The stretches covered by strings of ``length`` bytes that a context of an earlier document
    holds too, as context, begin and end; by the suffix array of them all."""
    lengths = np.array([len(c) for c in contexts], np.int64)
    joined = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8).astype(np.uint16) + 2
    begins = np.cumsum(lengths + 1) - lengths - 1
    joined[begins + lengths] = PART_END
    text = np.append(joined, np.uint16(0))
    suffixes = suffix_array(text)
    common = common_prefixes(text, suffixes, begins, lengths, length)
    owner = np.repeat(np.arange(len(contexts)), lengths + 1)
    offset = np.arange(len(owner)) - begins[owner]
    starts = offset + length <= lengths[owner]
    # Strings in sorted order: a new one begins where the common prefix falls short.
    ordered = suffixes[suffixes < len(owner)]
    ordered = ordered[starts[ordered]]
    doc = docs[owner[ordered]]
    new = common[ordered] < length
    new[:1] = True
    least = np.minimum.reduceat(doc, np.flatnonzero(new)) if len(doc) else doc
    later = np.zeros(len(owner), bool)
    later[ordered[doc > least[np.cumsum(new) - 1]]] = True if len(doc) else False
    # Strings that begin within a string before them, in the same context, prolong its stretch.
    at = np.flatnonzero(later)
    context, begin = owner[at], offset[at]
    new = np.append(True, (context[1:] != context[:-1]) | (begin[1:] > begin[:-1] + length))[: len(at)]
    last = np.append(new[1:], True)[: len(at)]
    return context[new], begin[new], begin[last] + length


def _crowded(contexts: DataFrame, length: int) -> DataFrame:
    """Spans of repeats among the contexts of very common grams: minima of digests, taken
    before rows are shuffled, whose join can be split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for one, begin, context in zip(*[batch.column(n).to_pylist() for n in ("id", "begin", "context")], strict=True):
                for k in range(len(context) - length + 1):
                    out[0].append(one)
                    out[1].append(begin + k)
                    out[2].append(xxhash.xxh3_128_digest(context[k : k + length]))
            kinds = (("id", pa.int64()), ("at", pa.int32()), ("digest", pa.binary()))
            yield pa.RecordBatch.from_pydict({n: pa.array(v, t) for (n, t), v in zip(kinds, out, strict=True)})

    strings = keep(contexts.mapInArrow(run, "id long, at int, digest binary"), "repeats-crowded")
    least = strings.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    found = strings.join(dealt_anew(least), "digest").where("id > least")
    return found.select("id", F.col("at").alias("begin"), (F.col("at") + length).alias("end"))


def _spans(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """``id, begin, end``: bytes covered by repeats among the contexts."""
    sizes = contexts.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    crowded = keep(sizes.where(F.col("n") > _CROWDED).select("key"), "repeats-crowded-keys")
    more = None
    if not crowded.isEmpty():
        more = _crowded(contexts.join(crowded, "key", "left_semi"), length)
        contexts = contexts.join(crowded, "key", "left_anti")
    shards = max(1, -(-contexts.count() // _SHARD))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        key, ids, begins, at = (frame[n].to_numpy(np.int64) for n in ("key", "id", "begin", "gram"))
        contexts = [bytes(c) for c in frame["context"]]
        left = np.flatnonzero(may_repeat(contexts, key, at, ids, length, gram))
        ids, begins = ids[left], begins[left]
        context, begin, end = repeats([contexts[k] for k in left.tolist()], ids, length)
        let_go()
        return pd.DataFrame({"id": ids[context], "begin": begins[context] + begin, "end": begins[context] + end})

    dealt = contexts.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    spans = dealt.groupBy("shard").applyInPandas(run, "id long, begin int, end int")
    return spans.unionByName(more) if more is not None else spans


def drop_repeats(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """Every row without the bytes covered by strings of ``length`` bytes that also start in
    a document of smaller identifier: ``id_col, n_bytes, n_removed, spans, kept``.

    ``spans`` are the maximal runs removed, as (begin, end); ``kept`` the other bytes joined.
    Texts are UTF-8 bytes, null counts as empty; matches end with a text, and overlap. A
    row without identifier takes no part and is kept whole. Identifiers are taken to be
    unique: rows that share one get what is found for either, as far as their texts go. Further
    columns play no part; an empty table gives an empty result. Contexts are taken for
    equal if their gram's hash and their digest are, 88 bits and more; all else is compared
    byte by byte, but for strings around grams with over 65,536 different contexts, which
    are compared by 128-bit digests.
    """
    ship(df.sparkSession)
    rows = df.selectExpr(f"cast(`{id_col}` as long) id", f"coalesce(`{text_col}`, '') text")
    named = rows.where("id is not null")
    (size,) = named.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    grams = max(1, size // 15)
    key_bits = min(64, max(40, grams.bit_length() + 14))
    ranges = -(-grams // _RANGE)
    hot = _hot(named, grams, key_bits, length, gram)
    selected = _selected(named, ranges, key_bits, length, gram, hot)
    places = selected.where(F.col("range") < 2 * ranges).groupBy("range").applyInPandas(_settled, "id long, at int, key long")
    if len(hot):
        places = places.unionByName(_settled_hot(_unpacked(selected.where(F.col("range") == 2 * ranges))))
    places = keep(places, "repeats-places")
    contexts = keep(_contexts(named, places.where("key is not null"), length, gram), "repeats-contexts")
    spans = keep(_spans(contexts, length, gram), "repeats-spans")

    covered = places.where("key is null").select(
        "id", (F.col("at") - (length - gram)).alias("begin"), (F.col("at") + length).alias("end")
    )
    by_doc = covered.unionByName(spans).groupBy("id").agg(F.collect_list(F.struct("begin", "end")).alias("s"))
    by_doc = by_doc.select("id", F.col("s.begin").alias("begin"), F.col("s.end").alias("end"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in _parts(batches):
            out: dict[str, list] = {"n_bytes": [], "n_removed": [], "spans": [], "kept": []}
            columns = [batch.column(n).to_pylist() for n in ("packed", "begin", "end")]
            for packed, begins, ends in zip(*columns, strict=True):
                data = unpack.decompress(packed)
                removed: list[list[int]] = []
                for begin, end in sorted(zip(begins or (), ends or (), strict=True)):
                    begin, end = max(begin, 0), min(end, len(data))
                    if end - begin < length:
                        continue
                    if removed and begin <= removed[-1][1]:
                        removed[-1][1] = max(removed[-1][1], end)
                    else:
                        removed.append([begin, end])
                cuts = [0, *(x for run in removed for x in run), len(data)]
                kept = [data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
                out["n_bytes"].append(len(data))
                out["n_removed"].append(sum(b - a for a, b in removed))
                out["spans"].append([{"begin": a, "end": b} for a, b in removed])
                out["kept"].append(b"".join(kept))
            kinds = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "kept": pa.binary()}
            kinds["spans"] = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_pydict({id_col: batch.column("id")} | {n: pa.array(v, kinds[n]) for n, v in out.items()})
        let_go()

    joined = packed_texts(rows).join(by_doc, "id", "left").select("id", "packed", "begin", "end")
    schema = f"`{id_col}` long, n_bytes long, n_removed long, spans array<struct<begin: long, end: long>>, kept binary"
    return joined.mapInArrow(cut, schema)
