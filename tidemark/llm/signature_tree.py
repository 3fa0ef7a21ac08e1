"""Jaccard self-join of documents' word shingles with signature trees.

Documents that are similar enough share one of their first shingles in any order common to
all (prefix filter), so a tree is built over the documents of each such shingle. Its leaves
are documents: a bitmap with a bit for each shingle's hash, the number of shingles, and the number
of shingles that found their bit taken. Inner nodes hold the OR of their bitmaps, the range of
sizes and the most taken bits; the highest levels of a large tree span several tasks. A dual
traversal starts with the root against itself and drops a pair of nodes if no document of one
and the other can have the overlap that their sizes ask for, or if all their documents are
known to be connected. Pairs of documents that are left are confirmed on their full sets.

To keep confirmations few, the first round takes each document's largest list only, and its
most promising partners there; what they connect is known, and a second round takes all pairs that
are still open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.minhash import _mixed, shingles
from tidemark.llm.shared import dealt_anew, keep, let_go, packed_texts, ship
from tidemark.session import BROADCAST_ROWS, has_at_most

#: Documents of a subtree that one task builds.
BLOCK = 1024
#: Children of a node, and partners of a document in the first round.
_FAN, _FOREMOST = 8, 4
#: Bits of the smallest bitmap: in small ones many unlike shingles would share a bit, and their pairs be left to confirm.
_LEAST_BITS = 1024
#: One document in so many is looked at for frequent shingles, of which there are so many at most.
_SAMPLE, FREQUENT = 16, 1 << 20
#: Times that a frequent shingle is found there at least.
_OFTEN = 3
#: Pairs of nodes looked at together; texts of a batch.
_PAIRS, _TEXTS = 4096, 256
#: Shingles of prefixes that a task holds before it deals them to buckets, and those of a bucket.
_POSTINGS, _BUCKET = 1 << 19, 1 << 18
_DESCRIBED = """id long, n_shingles long, digest binary, node long, bits binary, often long, lead long, bucket long, shingles binary, nodes binary, leads binary"""


def prefix(hashes: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a set, of which a similar one must share one: frequent ones come last."""
    n = len(hashes)
    length = n - -(-percent * n // 100) + 1
    if len(frequent) and n:
        often = frequent[np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)] == hashes
        hashes = np.concatenate([hashes[~often], hashes[often]])
    return hashes[:length]


def _leading(n: int, percent: int) -> int:
    """So many shingles of a set of ``n`` hold one of a similar set that is as large or larger."""
    return n - -(-2 * percent * n // (100 + percent)) + 1


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """A bit for each hash, as 64-bit words: a power of two of bits, two for each hash or more, and ``_LEAST_BITS``.

    A shorter bitmap of the same set is the OR of the halves of a longer one.
    """
    bits = max(_LEAST_BITS, 1 << (2 * len(hashes) - 1).bit_length())
    taken = np.zeros(bits, bool)
    taken[(hashes & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(taken).view(np.uint64)


def _folded(words: np.ndarray, length: int) -> np.ndarray:
    """Bitmaps (the last axis) of so many words."""
    while words.shape[-1] > length:
        half = words.shape[-1] // 2
        words = words[..., :half] | words[..., half:]
    return words


class Nodes:
    """A level of a tree: ``bits`` (a row for each node), the ``least`` and ``most`` shingles of a document,
    the most of them whose bit was ``taken``, and the ``component`` of all its documents, -1 if several."""

    def __init__(self, bits: np.ndarray, least: np.ndarray, most: np.ndarray, taken: np.ndarray, component: np.ndarray):
        self.bits, self.least, self.most, self.taken, self.component = bits, least, most, taken, component

    def __len__(self) -> int:
        return len(self.least)

    @classmethod
    def leaves(cls, bits: np.ndarray, size: np.ndarray, component: np.ndarray) -> Nodes:
        """Documents."""
        return cls(bits, size, size, size - np.bitwise_count(bits).sum(axis=1, dtype=np.int64), component)

    def above(self) -> Nodes:
        """The level above."""
        at = np.arange(0, len(self), _FAN)
        low, high = np.minimum.reduceat(self.component, at), np.maximum.reduceat(self.component, at)
        return Nodes(
            np.bitwise_or.reduceat(self.bits, at, axis=0),
            np.minimum.reduceat(self.least, at),
            np.maximum.reduceat(self.most, at),
            np.maximum.reduceat(self.taken, at),
            np.where(low == high, low, -1),
        )

    def tree(self) -> list[Nodes]:
        """All levels, this one first."""
        levels = [self]
        while len(levels[-1]) > 1:
            levels.append(levels[-1].above())
        return levels


def _fit(one: Nodes, i: np.ndarray, other: Nodes, j: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of nodes may hold an open link, and the shared shingles they can have to spare."""
    least_a, most_a, least_b, most_b = one.least[i], one.most[i], other.least[j], other.most[j]
    possible = (one.component[i] != other.component[j]) | (one.component[i] == -1)
    possible &= (100 * most_a >= percent * least_b) & (100 * most_b >= percent * least_a)
    shared = np.zeros(len(i), np.int64)
    at = np.flatnonzero(possible)
    shared[at] = np.bitwise_count(one.bits[i[at]] & other.bits[j[at]]).sum(axis=1, dtype=np.int64)
    shared += np.minimum(one.taken[i], other.taken[j])
    # 100 * shared >= percent * (a + b - shared), for the smallest documents of the two nodes.
    spare = shared - -(-percent * (least_a + least_b) // (100 + percent))
    return possible & (spare >= 0), spare


def dual_traversal(one: list[Nodes], other: list[Nodes] | None, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of leaves ``i, j`` that may be linked, with what they can have to spare.

    Of two trees, or of one (``other`` is None) with itself: then every pair comes once, ``i < j``.
    Pairs of nodes are opened depth first, a bounded number at a time.
    """
    same = other is None
    other = one if other is None else other
    stack = [(len(one) - 1, len(other) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    fan = np.arange(_FAN)
    while stack:
        a, b, i, j = stack.pop()
        if len(i) > _PAIRS:
            stack.append((a, b, i[_PAIRS:], j[_PAIRS:]))
            i, j = i[:_PAIRS], j[:_PAIRS]
        fits, spare = _fit(one[a], i, other[b], j, percent)
        i, j = i[fits], j[fits]
        if not len(i):
            continue
        if a == b == 0:
            yield i, j, spare[fits]
            continue
        # The higher of the two nodes is opened, both if they are equally high.
        high = max(a, b)
        if a == high:
            i, j, a = (i[:, None] * _FAN + fan).ravel(), np.repeat(j, _FAN), a - 1
        if b == high:
            i, j, b = np.repeat(i, _FAN), (j[:, None] * _FAN + fan).ravel(), b - 1
        inside = (i < len(one[a])) & (j < len(other[b]))
        if same:
            inside &= (i < j) if a == 0 else (i <= j)
        stack.append((a, b, i[inside], j[inside]))


def _foremost(owner: np.ndarray, spare: np.ndarray, most: int) -> np.ndarray:
    """Which rows are among the ``most`` with most to spare of their owner."""
    order = np.lexsort((-spare, owner))
    begins = np.append(True, owner[order][1:] != owner[order][:-1])
    places = np.arange(len(order)) - np.maximum.accumulate(np.where(begins, np.arange(len(order)), 0))
    chosen = np.zeros(len(order), bool)
    chosen[order[places < most]] = True
    return chosen


def _pairs(one: list[Nodes], other: list[Nodes] | None, percent: int, most: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of leaves of the traversal: all, or those that are among the ``most`` with most to spare of
    either leaf."""
    held: list[tuple[np.ndarray, ...]] = []
    size = bound = 0

    def thinned() -> tuple[np.ndarray, ...]:
        i, j, spare = (np.concatenate(x) for x in zip(*held)) if held else (np.empty(0, np.int64),) * 3
        if most is None or not len(i):
            return i, j, spare
        if other is None:
            both = _foremost(np.concatenate([i, j]), np.concatenate([spare, spare]), most)
            kept = both[: len(i)] | both[len(i) :]
        else:
            kept = _foremost(i, spare, most) | _foremost(j, spare, most)
        return i[kept], j[kept], spare[kept]

    for found in dual_traversal(one, other, percent):
        held.append(found)
        size += len(found[0])
        if most is not None and size > bound:
            held = [thinned()]
            size = len(held[0][0])
            bound = 2 * size + 16 * _PAIRS
    return thinned()


_BLOCKS = """g long, block long, a array<long>, b array<long>, spare array<long>, ids binary, sizes binary, components binary,
bits binary, least long, most long, taken array<long>, component long, any_bits binary"""


def _blocks(rows: DataFrame, percent: int, most: int | None, block: int) -> DataFrame:
    """Subtrees of sorted rows ``g, id, size, component, bits``, and the open pairs ``a, b, spare`` inside each.

    A list's documents lie in the order of their sizes, and no link leads over a gap between sizes
    that is too wide. A block is at most ``block`` documents between two gaps. Its documents go
    along only if others of the same list may lie in another block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _BLOCKS.replace("\n", " ").split(", ")]
        types = [pa.int64()] * 2 + [pa.list_(pa.int64())] * 3 + [pa.binary()] * 4 + [pa.int64()] * 2
        schema = pa.schema(list(zip(names, [*types, pa.list_(pa.int64()), pa.int64(), pa.binary()])))
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        out: list[tuple] = []
        first = True  # whether the block may go on in the task before

        def close(g: int, open_end: bool) -> None:
            nonlocal number, first
            ids, size, component = (np.array(x, np.int64) for x in list(zip(*held))[:3])
            width = min(len(row[3]) for row in held) // 8
            bits = np.stack([_folded(np.frombuffer(row[3], np.uint64), width) for row in held])
            held.clear()
            leaves = Nodes.leaves(bits, size, component)
            tree = leaves.tree()
            i, j, spare = _pairs(tree, None, percent, most)
            row = [g, number, ids[i], ids[j], spare]
            if first or open_end:
                taken = []
                while True:
                    taken.append(int((size - np.bitwise_count(_folded(bits, 1 << len(taken))).sum(axis=1)).max()))
                    if 1 << len(taken) > width:
                        break
                root = tree[-1]
                row += [ids.tobytes(), size.tobytes(), component.tobytes(), bits.tobytes()]
                row += [int(size.min()), int(size.max()), taken, int(root.component[0]), root.bits[0].tobytes()]
                out.append(tuple(row))
            elif len(i):
                out.append((*row, *[None] * 9))
            number, first = number + 1, open_end

        def table() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[]] * len(schema)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        last = 0
        for batch in batches:
            for g, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held:
                    if g != last or 100 * held[-1][1] < percent * row[1]:
                        close(last, False)
                    elif len(held) == block:
                        close(last, True)
                last = g
                held.append(row)
            if len(out) > 500:
                yield table()
        if held:
            close(last, True)
        yield table()

    return keep(rows.mapInArrow(run, _BLOCKS), "signature-blocks")


def _across(blocks: DataFrame, percent: int, most: int | None) -> DataFrame:
    """Open pairs ``a, b, spare`` of documents of one list in different blocks.

    The blocks' roots are leaves of the highest levels of the list's tree, which one task traverses. With
    ``most`` only neighbouring blocks are taken.
    """
    roots = blocks.where("ids is not null").select("g", "block", "least", "most", "taken", "component", "any_bits")
    if most is not None:
        before = F.lag("block").over(Window.partitionBy("g").orderBy("block"))
        pairs = roots.select("g", before.alias("i"), F.col("block").alias("j")).where("i is not null")
    else:
        several = roots.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("g")

        def run(frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values("block", ignore_index=True)
            bitmaps = [np.frombuffer(b, np.uint64) for b in frame["any_bits"]]
            width = min(map(len, bitmaps))
            level = width.bit_length() - 1
            nodes = Nodes(
                np.stack([_folded(b, width) for b in bitmaps]),
                frame["least"].to_numpy(),
                frame["most"].to_numpy(),
                np.array([t[level] for t in frame["taken"]], np.int64),
                frame["component"].to_numpy(),
            )
            i, j, _ = _pairs(nodes.tree(), None, percent, None)
            numbers = frame["block"].to_numpy()
            return pd.DataFrame({"g": frame["g"].iat[0], "i": numbers[i], "j": numbers[j]})

        pairs = roots.join(several, "g", "left_semi").groupBy("g").applyInPandas(run, "g long, i long, j long")

    def documents(side: str, name: str) -> DataFrame:
        columns = [F.col(c).alias(f"{name}_{c}") for c in ("ids", "sizes", "components", "bits")]
        return blocks.where("ids is not null").select("g", F.col("block").alias(side), *columns)

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sides = []
                for name in ("one", "other"):
                    ids, size, component = (np.frombuffer(row[f"{name}_{c}"], np.int64) for c in ("ids", "sizes", "components"))
                    sides.append((ids, np.frombuffer(row[f"{name}_bits"], np.uint64).reshape(len(ids), -1), size, component))
                width = min(bits.shape[1] for _, bits, _, _ in sides)
                one, other = (Nodes.leaves(_folded(bits, width), size, part).tree() for _, bits, size, part in sides)
                i, j, spare = _pairs(one, other, percent, most)
                yield pa.RecordBatch.from_pydict({"a": pa.array(sides[0][0][i]), "b": pa.array(sides[1][0][j]), "spare": pa.array(spare)})

    rows = pairs.join(documents("i", "one"), ["g", "i"]).join(documents("j", "other"), ["g", "j"]).drop("g", "i", "j")
    return rows.mapInArrow(cross, "a long, b long, spare long")


def _candidates(
    members: DataFrame, labels: DataFrame | None, documents: DataFrame, percent: int, most: int | None, block: int, looked: DataFrame | None = None
) -> DataFrame:
    """Pairs ``a, b`` of documents that share a list, may be linked, and are not known to be connected; none of ``looked``."""
    component = F.col("id")
    if labels is not None:
        members = members.join(labels.withColumnRenamed("node", "id"), "id", "left")
        component = F.coalesce("component", "id")
    named = members.select("g", "id", component.alias("component"))
    if labels is not None:
        named = keep(named, "signature-named")
        still = named.groupBy("g").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most")
        named = named.join(dealt_anew(still.select("g")), "g")
    rows = named.join(documents, "id").select("g", "id", "size", "component", "bits")
    order = ["g", "size", "component", "id"]
    blocks = _blocks(rows.repartitionByRange(*order).sortWithinPartitions(*order), percent, most, block)
    pair = F.inline(F.arrays_zip("a", "b", "spare"))
    found = blocks.where("size(a) > 0").select(pair).unionByName(_across(blocks, percent, most))
    found = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    found = found.select("a", "b").distinct()
    if looked is not None:
        found = found.join(looked, ["a", "b"], "left_anti")
    return keep(found, "signature-candidates")


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    # Identifiers only, broadcast if measured to be few.
    ids = F.broadcast(ids) if has_at_most(ids, BROADCAST_ROWS) else ids
    packed = keep(packed_texts(texts.join(ids, "id", "left_semi")), "signature-texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        last, known = None, np.empty(0, np.uint64)
        for batch in batches:
            a, b = [], []
            for one, other, one_text, other_text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if last != (other, other_text):
                    last, known = (other, other_text), shingles(unpack.decompress(other_text).decode(), size)
                own = shingles(unpack.decompress(one_text).decode(), size)
                common = len(np.intersect1d(own, known, assume_unique=True))
                if 100 * common >= percent * (len(own) + len(known) - common):
                    a.append(one)
                    b.append(other)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    rows = pairs.join(packed.select(F.col("id").alias("a"), F.col("packed").alias("one")), "a")
    rows = rows.join(packed.select(F.col("id").alias("b"), F.col("packed").alias("other")), "b")
    return keep(rows.select("a", "b", "one", "other").mapInArrow(run, "a long, b long"), "signature-links")


def _frequent(df: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Shingles found often in one document of some: sorted, at most ``FREQUENT`` of them; and how many
    shingles those documents have.

    They say which shingles come last, which may be any, and which are joined row by row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict({"shingle": pa.array(shingles(text, size).view(np.int64))})

    some = df.where(F.pmod(F.xxhash64("id"), F.lit(_SAMPLE)) == 0).select("text")
    counts = keep(some.mapInArrow(run, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("n")), "signature-sample")
    total = counts.agg(F.sum("n")).first()[0] or 0
    # Those found this often are no more than ``FREQUENT``, being that share of all occurrences; most times rarer ones fit as well.
    least = max(_OFTEN, -(-total // FREQUENT))
    capped = counts.where(F.col("n") >= _OFTEN).groupBy(F.least("n", F.lit(least)).alias("n")).agg(F.count(F.lit(1)).alias("shingles"))
    kinds, found = dict(capped.collect()), 0
    for n in range(least, _OFTEN - 1, -1):
        found += kinds.get(n, 0)
        if found > FREQUENT:
            break
        least = n
    often = counts.where(F.col("n") >= least).select("shingle").toPandas()["shingle"]
    return np.sort(often.to_numpy(np.int64).view(np.uint64)), total


def _described(df: DataFrame, frequent: np.ndarray, buckets: int, size: int, percent: int) -> DataFrame:
    """Rows of documents, ``id, n_shingles, digest, node, bits``, and besides of the shingles of their prefixes.

    ``node`` is a hash of the digest; documents of equal sets have one. A shingle that is not
    frequent goes to a ``bucket`` by its first bits, with others of the same batch: ``shingles``, ``nodes`` and ``leads``
    hold 32 bits of each, the nodes, and whether the smaller set of a similar pair may begin
    with it, one after the other. Of a frequent one comes the row ``often, node, lead``.
    """
    shared = df.sparkSession.sparkContext.broadcast(frequent)
    names = [c.split()[0] for c in _DESCRIBED.split(", ")]

    def table(**columns: pa.Array) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        types = dict.fromkeys(("id", "n_shingles", "node", "often", "lead", "bucket"), pa.int64())
        return pa.RecordBatch.from_pydict({c: columns.get(c, pa.nulls(n, types.get(c, pa.binary()))) for c in names})

    def postings(held: dict[int, tuple[np.ndarray, int]]) -> Iterator[pa.RecordBatch]:
        """The prefixes of some nodes, each node once."""
        if not held:
            return
        sizes = np.array([len(x) for x, _ in held.values()])
        nodes = np.repeat(np.fromiter(held, np.int64, len(held)), sizes)
        tokens = np.concatenate([x for x, _ in held.values()])
        places = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        leads = places < np.repeat([n for _, n in held.values()], sizes)
        held.clear()
        often = np.zeros(len(tokens), bool)
        if len(shared.value):
            often = shared.value[np.minimum(np.searchsorted(shared.value, tokens), len(shared.value) - 1)] == tokens
        yield table(often=pa.array(tokens[often].view(np.int64)), node=pa.array(nodes[often]), lead=pa.array(leads[often].astype(np.int64)))
        order = np.flatnonzero(~often)
        order = order[np.argsort(tokens[order])]
        tokens, nodes, leads = tokens[order], nodes[order], leads[order]
        bucket = ((tokens >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(tokens)] if len(tokens) else [0]
        parts = list(zip(cuts, cuts[1:]))
        yield table(
            bucket=pa.array([int(bucket[i]) for i, _ in parts], pa.int64()),
            shingles=pa.array([tokens[i:j].astype(np.uint32).tobytes() for i, j in parts], pa.binary()),
            nodes=pa.array([nodes[i:j].tobytes() for i, j in parts], pa.binary()),
            leads=pa.array([leads[i:j].tobytes() for i, j in parts], pa.binary()),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, int]] = {}
        n = 0
        for whole in batches:
            for at in range(0, whole.num_rows, _TEXTS):
                batch = whole.slice(at, _TEXTS)
                sets = [shingles(text, size) for text in batch.column(1).to_pylist()]
                digests = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets]
                nodes = [xxhash.xxh3_64_intdigest(d) - (1 << 63) if d else None for d in digests]
                yield table(
                    id=batch.column(0),
                    n_shingles=pa.array([len(x) for x in sets], pa.int64()),
                    digest=pa.array(digests, pa.binary()),
                    node=pa.array(nodes, pa.int64()),
                    bits=pa.array([bitmap(x).tobytes() if len(x) else None for x in sets], pa.binary()),
                )
                for node, hashes, doc in zip(nodes, sets, batch.column(0).is_valid().to_pylist()):
                    if node is not None and doc and node not in held:
                        held[node] = prefix(hashes, shared.value, percent), _leading(len(hashes), percent)
                        n += len(held[node][0])
                if n >= _POSTINGS:
                    yield from postings(held)
                    n = 0
        yield from postings(held)
        let_go()

    return keep(df.select("id", "text").mapInArrow(run, _DESCRIBED), "signature-sets")


def _rare_lists(described: DataFrame) -> DataFrame:
    """``n, mark, other, part, nodes``: the nodes that share a shingle, for each shingle of a bucket that two
    have, one of them as a leading one.

    Lists of the same nodes have the same marks. A list goes in parts, each with ``BLOCK`` nodes at most.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        tokens = np.concatenate([np.frombuffer(x, np.uint32) for x in frame["shingles"]])
        nodes = np.concatenate([np.frombuffer(x, np.int64) for x in frame["nodes"]])
        leads = np.concatenate([np.frombuffer(x, bool) for x in frame["leads"]])
        order = np.lexsort((~leads, nodes, tokens))
        tokens, nodes, leads = tokens[order], nodes[order], leads[order]
        # A node comes from every batch that has one of its documents.
        first = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (nodes[1:] != nodes[:-1])])
        tokens, nodes, leads = tokens[first], nodes[first], leads[first]
        begins = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        n = np.diff(np.append(begins, len(tokens)))
        mixed = _mixed(nodes.view(np.uint64))
        mark, other = np.add.reduceat(mixed, begins), np.add.reduceat(_mixed(mixed), begins)
        several = np.flatnonzero((n > 1) & np.logical_or.reduceat(leads, begins))
        _, once = np.unique(np.stack([mark[several], other[several]]), axis=1, return_index=True)
        rows = [
            (int(n[k]), int(mark.view(np.int64)[k]), int(other.view(np.int64)[k]), part, nodes[at : min(at + BLOCK, begins[k] + n[k])].tobytes())
            for k in several[once].tolist()
            for part, at in enumerate(range(begins[k], begins[k] + n[k], BLOCK))
        ]
        return pd.DataFrame(rows, columns=["n", "mark", "other", "part", "nodes"])

    rows = described.where("bucket is not null").select("bucket", "shingles", "nodes", "leads")
    lists = rows.groupBy("bucket").applyInPandas(run, "n long, mark long, other long, part long, nodes binary")
    return lists.dropDuplicates(["n", "mark", "other", "part"])


def _lists(described: DataFrame, reps: DataFrame) -> DataFrame:
    """``g, id, n``: the documents that share a shingle of their prefixes; each set of documents once.

    Frequent shingles are joined row by row, so that those of one that many documents share can be split.
    """

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = [np.frombuffer(x, np.int64) for x in batch.column(2).to_pylist()]
            for g, n, some in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), nodes):
                yield pa.RecordBatch.from_pydict(
                    {"g": pa.array(np.full(len(some), g)), "n": pa.array(np.full(len(some), n)), "node": pa.array(some)}
                )

    rare = _rare_lists(described).select(F.xxhash64("n", "mark", "other").alias("g"), "n", "nodes")
    rare = rare.mapInArrow(unpacked, "g long, n long, node long")
    often = described.where("often is not null").groupBy(F.col("often").alias("g"), "node").agg(F.max("lead").alias("lead"))
    half = F.lit(0xFFFFFFFF)
    lists = often.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("lead").alias("lead"),
        *[F.sum(F.xxhash64("node", F.lit(k)).bitwiseAND(half)).alias(f"mark{k}") for k in range(3)],
    )
    lists = lists.where("n > 1 and lead = 1").groupBy("n", "mark0", "mark1", "mark2").agg(F.min("g").alias("g")).select("g", "n")
    often = often.join(dealt_anew(lists), "g").select("g", "n", "node")
    return keep(rare.unionByName(often).join(reps.select("node", "id"), "node").select("g", "id", "n"), "signature-lists")


def similar_classes(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80, block: int = BLOCK
) -> DataFrame:
    """Every row's class under links between similar texts: ``id_col, n_shingles, component_id``.

    Two documents are linked if 100 times their common shingles of ``size`` words are at least ``percent``
    (1 to 100) times those of either; fewer words than ``size`` are one shingle. ``component_id`` is the
    smallest identifier that links lead to, the row's own included. Null and empty texts, and those
    of white space, have no shingles and are linked with nothing; so is a row without identifier,
    which has no component. Rows of one identifier are one document, linked with what any of
    them is linked with. Identifiers are integers; further columns play no part; an empty table
    gives an empty result. A task takes ``block`` documents of a tree at a time.
    """
    ship(df.sparkSession)
    rows = df.selectExpr(f"cast(`{id_col}` as long) id", f"`{text_col}` text")
    frequent, total = _frequent(rows, size)
    buckets = 1 + total * (100 - percent) // 100 * _SAMPLE // _BUCKET
    everything = _described(rows, frequent, buckets, size, percent)
    described = everything.where("n_shingles is not null").select("id", "n_shingles", "digest", "node", "bits")
    # Documents of equal sets are one class from the start, under its smallest identifier.
    first = described.where("digest is not null and id is not null").groupBy("digest", "node").agg(F.min("id").alias("id"))
    reps = keep(first, "signature-classes")
    members = _lists(everything, reps)
    ids = members.select("id").distinct()
    documents = described.join(ids, "id", "left_semi").dropDuplicates(["id", "node"])
    documents = keep(documents.select("id", F.col("n_shingles").alias("size"), "bits"), "signature-bitmaps")
    texts = rows.where("id is not null and text is not null")

    # The first round takes the largest list of every document only.
    largest = members.groupBy("id").agg(F.max(F.struct("n", "g")).alias("most")).select("most.g").distinct()
    members = members.select("g", "id")
    first_lists = members.join(largest, "g", "left_semi")
    looked = _candidates(first_lists, None, documents, percent, _FOREMOST, block)
    links = _confirmed(looked, texts, size, percent)
    # An identifier with several texts connects their classes.
    texts_of = described.where("digest is not null").groupBy("id").agg(F.min("digest").alias("least"), F.max("digest").alias("most"))
    several = described.join(texts_of.where("least < most").select("id"), "id", "left_semi").select(F.col("id").alias("a"), "digest")
    same = several.join(reps.select("digest", F.col("id").alias("b")), "digest").select("a", "b")
    labels = keep(components(links.unionByName(same)), "signature-components")
    more = _confirmed(_candidates(members, labels, documents, percent, None, block, looked), texts, size, percent)
    if not more.isEmpty():
        # The stars found so far stand for the links they come from.
        stars = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
        labels = keep(components(stars.unionByName(more)), "signature-components")

    labels = labels.select(F.col("node").alias("id"), "component")
    found = reps.join(labels, "id", "left").select("digest", F.coalesce("component", "id").alias("component"))
    result = described.drop("bits").join(found, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return result.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"))
