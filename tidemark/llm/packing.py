"""Packing documents into training windows by sums of squares, online.

Every task takes the documents of its partition as they come. It cuts full windows off a
document, and puts the rest into that fill level which minimises the sum, over the levels,
of the squared numbers of partially filled windows; a level array holds these numbers.
When its documents end, the emptiest windows are cut up to fill the fullest, so that a
task leaves one window with padding at most. So it does when the open windows hold some
millions of ids, as windows of documents that do not fit together would grow in number without end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.bpe import byte_bpe
from tidemark.llm.shared import ship

#: Sequences of one task are numbered within a range of this size.
SEQUENCES_PER_TASK = 1 << 36
#: Ids that a task's open windows hold at most, besides those of the latest document.
HELD = 1 << 23
_PIECES = 1000


class SumOfSquares:
    """Windows of ``size`` tokens; gives out (sequence, offset, piece) once a window is settled.

    A piece is a tuple (document, start, ids, tokens of the document).
    """

    def __init__(self, size: int, most: int = HELD):
        self.size, self.most, self.sequences, self.held = size, most, 0, 0
        self.level = np.zeros(size + 1, np.int64)
        self.open: list[list[list[tuple]]] = [[] for _ in range(size + 1)]

    def _settled(self, pieces: list[tuple]) -> list[tuple]:
        out, offset = [], 0
        for piece in pieces:
            out.append((self.sequences, offset, piece))
            offset += len(piece[2])
        self.sequences += 1
        return out

    def _filled(self) -> list[tuple]:
        """Room for more documents, if the open windows hold too many ids."""
        return self.close() if self.held > self.most else []

    def place(self, doc, ids: np.ndarray) -> list[tuple]:
        total, at, out = len(ids), 0, []
        while total - at >= self.size:
            out += self._settled([(doc, at, ids[at : at + self.size], total)])
            at += self.size
        rest = total - at
        if not rest:
            return out
        # Change of the sum of squares: from level h to h + rest, or from nothing to rest.
        fills = self.level[: self.size + 1 - rest]
        after = self.level[rest:].copy()
        change = 2 * (after - fills) + 2
        change[-1] = 1 - 2 * fills[-1]  # a full window counts no more
        change[0] = 2 * after[0] + 1
        change[1:][fills[1:] == 0] = np.iinfo(np.int64).max
        best = len(change) - 1 - int(np.argmin(change[::-1]))  # of equals the fullest
        pieces = []
        if best:
            pieces = self.open[best].pop()
            self.level[best] -= 1
        # A copy: the rest must not keep all ids of its batch.
        pieces.append((doc, at, ids[at:].copy(), total))
        if best + rest == self.size:
            self.held -= best
            return out + self._settled(pieces)
        self.open[best + rest].append(pieces)
        self.level[best + rest] += 1
        self.held += rest
        return out + self._filled()

    def close(self) -> list[tuple]:
        windows = [w for level in reversed(self.open) for w in level]
        out, first = [], 0
        while first < len(windows):
            pieces = windows[first]
            room = self.size - sum(len(p[2]) for p in pieces)
            while room and len(windows) - 1 > first:
                doc, start, ids, total = windows[-1].pop()
                pieces.append((doc, start, ids[:room], total))
                if len(ids) > room:
                    windows[-1].append((doc, start + room, ids[room:], total))
                room -= min(room, len(ids))
                if not windows[-1]:
                    windows.pop()
            out += self._settled(pieces)
            first += 1
        self.open = [[] for _ in range(self.size + 1)]
        self.level[:] = 0
        self.held = 0
        return out


def pack(
    df: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of all documents: ``id_col, start, length, ids, doc_tokens, sequence_id, offset``.

    A document is its text's ids and ``end_id``; every id lies in one piece. The pieces of
    a sequence lie gapless from offset 0; a sequence holds at most ``size`` ids, and at most
    one per partition of ``df``, and one in some millions of ids, holds fewer. ``ids`` are
    little-endian unsigned 32-bit integers. A null or empty text is its end id alone; rows repeated or with equal or null
    identifiers are documents of their own; further columns play no part; an empty table
    gives an empty result. A task holds its open windows only, with ``HELD`` ids at most.
    """
    ship(df.sparkSession)
    id_field = pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = byte_bpe(tokenizer), SumOfSquares(size)
        first, tail = TaskContext.get().partitionId() * SEQUENCES_PER_TASK, np.array([end_id], "<u4")

        def table(placed: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {
                    id_col: pa.array([p[0] for _, _, p in placed], id_field),
                    "start": pa.array([p[1] for _, _, p in placed], pa.int64()),
                    "length": pa.array([len(p[2]) for _, _, p in placed], pa.int64()),
                    "ids": pa.array([p[2].tobytes() for _, _, p in placed], pa.binary()),
                    "doc_tokens": pa.array([p[3] for _, _, p in placed], pa.int64()),
                    "sequence_id": pa.array([first + s for s, _, _ in placed], pa.int64()),
                    "offset": pa.array([o for _, o, _ in placed], pa.int64()),
                }
            )

        for batch in batches:
            docs = iter(batch.column(0).to_pylist())
            placed: list[tuple] = []
            for ids, lengths in encoder.encode_column(batch.column(1)):
                for part in np.split(ids, np.cumsum(lengths)[:-1]):
                    placed += packer.place(next(docs), np.concatenate([part, tail]))
                    if len(placed) >= _PIECES:
                        yield table(placed)
                        placed = []
            if placed:
                yield table(placed)
        if placed := packer.close():
            for at in range(0, len(placed), _PIECES):
                yield table(placed[at : at + _PIECES])

    schema = f"`{id_col}` long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return df.selectExpr(f"cast(`{id_col}` as long) id", f"`{text_col}` text").mapInArrow(run, schema)
