"""CSV records that may span lines, found by many tasks per file.

Whether a line begins inside a quoted cell is known by the quotes before it in its file: an odd
number of them means inside, as a quote within a cell is written twice. So a split of a file is an
automaton of two states, of which its parity of quotes decides whether it swaps them. An
index takes one row per split: its parity, and how many records begin in it from either
state. Composing the splits of a file by a prefix scan gives each one its first state, and the
number of the first record that begins in it. A record belongs to the split that it begins in;
what of it lies in later splits is brought there. Spark parses the records.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, DataFrameReader, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

_WHOLE, _HEAD, _TAIL = 0, 1, 2
_RECORDS = "value string, file string, block long, row long, place long, kind int"
_OUTSIDE = 'quotes inside an unquoted cell, or a line break outside quotes: {!r} is not one CSV record'


def lines_of(reader: DataFrameReader | DataStreamReader, paths: str | list[str]) -> DataFrame:
    """``value, file, block`` and file names: lines up to a line feed, in the order of a split."""
    lines = reader.format("text").option("lineSep", "\n").load(paths)
    names = {"file": "_metadata.file_path", "block": "_metadata.file_block_start", "file_name": "_metadata.file_name"}
    return lines.select("value", *[F.col(c).alias(n) for n, c in names.items()])


@dataclass
class Layout:
    """What a split needs to know of the splits before it: ``{file: {block: (state, first place)}}``."""

    splits: dict[str, dict[int, tuple[int, int]]] = field(default_factory=dict)
    #: Splits that begin or end inside a cell.
    cut: list[tuple[str, int]] = field(default_factory=list)
    records: int = 0


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """The lines of a batch, split by split."""
    if not batch.num_rows:
        return
    value, file, block = batch.column("value"), batch.column("file"), batch.column("block")
    changes = np.diff(block.to_numpy(zero_copy_only=False)) != 0
    changes |= pc.not_equal(file.slice(1), file.slice(0, len(file) - 1)).to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:]):
        yield file[begin].as_py(), block[begin].as_py(), value.slice(begin, end - begin)


def _marks(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of each line whether its quotes are odd, and whether it is blank."""
    odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) % 2
    blank = pc.equal(pc.ascii_trim_whitespace(lines), "").to_numpy(zero_copy_only=False)
    return odd.astype(np.int64), blank.astype(bool)


def may_span_lines(lines: DataFrame) -> bool:
    """Whether a line has an odd number of quotes, or a carriage return that does not end it; one scan.

    If none has, every line is a record, for Spark's own reader too.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    found = lines.agg(F.bool_or((quotes % 2 == 1) | F.col("value").rlike("\r.")).alias("found")).first()
    return bool(found["found"])


def _index(lines: DataFrame) -> DataFrame:
    """``file, block, parity, outside, inside``: a row for each split that holds a line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = []
        for batch in batches:
            for file, block, values in _stretches(batch):
                if not rows or rows[-1][:2] != [file, block]:
                    rows.append([file, block, 0, 0, 0])
                row = rows[-1]
                odd, blank = _marks(values)
                before = (row[2] + np.cumsum(odd) - odd) % 2
                row[2] = int(row[2] + odd.sum()) % 2
                row[3] += int(((before == 0) & ~blank).sum())
                row[4] += int(((before == 1) & ~blank).sum())
        names = ("file", "block", "parity", "outside", "inside")
        types = (pa.string(), *[pa.int64()] * 4)
        columns = list(zip(*rows)) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], list(names))

    schema = "file string, block long, parity long, outside long, inside long"
    return lines.select("value", "file", "block").mapInArrow(run, schema)


def layout(lines: DataFrame, header: bool) -> Layout:
    """One scan of the files; one row for each split comes to the driver, as its tasks do anyway."""
    found, place, last, state = Layout(), 0, None, 0
    for row in sorted(_index(lines).collect(), key=lambda r: (r["file"], r["block"])):
        if row["file"] != last:
            if state:
                raise ValueError(f"{last} ends inside a quoted cell")
            last, state = row["file"], 0
        found.splits.setdefault(row["file"], {})[row["block"]] = (state, place)
        if state or row["parity"]:
            found.cut.append((last, row["block"]))
        begun = row["inside" if state else "outside"]
        place += begun - (1 if header and row["block"] == 0 and begun else 0)
        state = (state + row["parity"]) % 2
    if state:
        raise ValueError(f"{last} ends inside a quoted cell")
    found.records = place
    return found


def _require_one_record(text: str, sep: str) -> str:
    """Spark's parser stops at the end of the first record of a text: there must be no second one."""
    try:
        n = sum(1 for _ in csv.reader([text], delimiter=sep, strict=True))
    except csv.Error:
        n = 0
    if n != 1:
        raise ValueError(_OUTSIDE.format(text[:200]))
    return text


class _Split:
    """Puts the lines of one split together to records; rows are (text, row, place, kind)."""

    def __init__(self, state: int, place: int, names: list[str] | None, sep: str, strict: bool):
        self.state, self.place, self.names, self.sep, self.strict = state, place, names, sep, strict
        # The header is no record.
        self.row = -1 if names is not None else 0
        self.pending: list[str] | None = [] if state else None
        self.kind, self.at = _HEAD if state else _WHOLE, -1

    def _check_header(self, text: str) -> None:
        cells = next(csv.reader([text], delimiter=self.sep), [])
        same = len(cells) == len(self.names) and all(
            a == b or not a or cells.count(a) > 1 for a, b in zip(cells, self.names)
        )
        if not same:
            raise ValueError(f"the header is {cells}, expected {self.names}")

    def _record(self, text: str, row: int, check: bool) -> Iterator[tuple[str, int, int]]:
        text = text.removesuffix("\r")
        if row < 0:
            self._check_header(text)
            return
        yield (_require_one_record(text, self.sep) if check else text), row, _WHOLE

    def add(self, lines: pa.Array) -> tuple[pa.Array, np.ndarray, list[tuple[str, int, int]]]:
        """Records of one line with their rows, and the others."""
        odd, blank = _marks(lines)
        if self.strict and odd.any():
            line = lines[int(odd.argmax())].as_py()
            raise ValueError(f"a cell holds a line break, or quotes are not doubled: {line[:200]!r}")
        before = (self.state + np.cumsum(odd) - odd) % 2
        begins = (before == 0) & ~blank
        rows = self.row + np.cumsum(begins) - begins
        plain = begins & (odd == 0)
        returns = pc.match_substring_regex(lines, "\r.").to_numpy(zero_copy_only=False).astype(bool)
        plain &= ~returns & (rows >= 0)
        others: list[tuple[str, int, int]] = []
        for k in np.flatnonzero(~plain & (begins | (before == 1))).tolist():
            text = lines[k].as_py()
            if before[k] == 0 and not odd[k]:
                others += self._record(text, int(rows[k]), check=True)
            elif before[k] == 0:
                self.pending, self.kind, self.at = [text], _WHOLE, int(rows[k])
            else:
                self.pending.append(text)
                if odd[k]:
                    others += self._closed()
        self.row += int(begins.sum())
        self.state = int(self.state + odd.sum()) % 2
        return pc.replace_substring_regex(lines.filter(pa.array(plain)), "\r$", ""), rows[plain], others

    def _closed(self) -> list[tuple[str, int, int]]:
        text, self.pending = "\n".join(self.pending), None
        if self.kind == _HEAD:
            self.kind = _WHOLE
            return [(text, -1, _HEAD)]
        return list(self._record(text, self.at, check=True))

    def end(self) -> list[tuple[str, int, int]]:
        """The part of a record that goes on in the next split."""
        if self.pending is None:
            return []
        if self.kind == _HEAD:
            return [("\n".join(self.pending), -1, _HEAD)] if self.pending else []
        if self.at < 0:
            raise ValueError("the header does not end in the first split of its file")
        return [("\n".join(self.pending), self.at, _TAIL)]


def records(
    lines: DataFrame,
    found: Layout | None,
    names: list[str] | None,
    sep: str,
    chunk: tuple[int, int] | None = None,
) -> DataFrame:
    """``value, file, block, row``: the records of the lines, of which ``row`` counts those of a split.

    ``names`` is the header that every file begins with, None if they have none. Without a layout each
    line has to be a record. ``chunk`` are the places (from, to) of the records wanted among those of
    all files; lines of splits without any are not put together.
    """
    shared = lines.sparkSession.sparkContext.broadcast(found.splits) if found else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, split = None, None

        def table(file: str, block: int, texts: pa.Array, rows: np.ndarray, kinds: np.ndarray) -> pa.RecordBatch:
            n, places = len(texts), rows + split.place
            keep = np.ones(n, bool) if chunk is None else (kinds != _WHOLE) | ((places >= chunk[0]) & (places < chunk[1]))
            columns = [texts, pa.array([file] * n, pa.string()), pa.array([block] * n, pa.int64()), pa.array(rows, pa.int64())]
            columns += [pa.array(places, pa.int64()), pa.array(kinds, pa.int32())]
            named = ("value", "file", "block", "row", "place", "kind")
            return pa.RecordBatch.from_arrays(columns, list(named)).filter(pa.array(keep))

        def others(file: str, block: int, rows: list[tuple[str, int, int]]) -> Iterator[pa.RecordBatch]:
            if rows:
                texts, numbers, kinds = zip(*rows)
                yield table(file, block, pa.array(texts, pa.string()), np.array(numbers, np.int64), np.array(kinds))

        for batch in batches:
            for file, block, values in _stretches(batch):
                if (file, block) != last:
                    if split is not None:
                        yield from others(*last, split.end())
                    state, place = (0, 0) if shared is None else _known(shared.value, file, block)
                    first = names if names is not None and block == 0 else None
                    split, last = _Split(state, place, first, sep, strict=shared is None), (file, block)
                texts, rows, rest = split.add(values)
                yield table(file, block, texts, rows, np.zeros(len(rows), np.int64))
                yield from others(file, block, rest)
        if split is not None:
            yield from others(*last, split.end())

    if chunk is not None:
        lines = _overlapping(lines, found, *chunk)
    columns = ["value", "file", "block", "row"]
    parts = lines.select("value", "file", "block").mapInArrow(run, _RECORDS)
    whole = parts.where(F.col("kind") == _WHOLE).select(columns)
    if found is None or not found.cut:
        return whole
    # Only splits that have a part of a record are put together again. By a condition on files alone Spark would
    # leave out the others, and then size the splits by the bytes that are left.
    cut = F.broadcast(lines.sparkSession.createDataFrame(found.cut, "file string, block long"))
    cut = lines.join(cut, ["file", "block"], "left_semi").select("value", "file", "block").mapInArrow(run, _RECORDS)
    return whole.unionByName(_joined(cut, sep, chunk).select(columns))


def _known(splits: dict[str, dict[int, tuple[int, int]]], file: str, block: int) -> tuple[int, int]:
    try:
        return splits[file][block]
    except KeyError:
        raise ValueError(f"{file} has changed, or is split otherwise, since it was indexed: read it again") from None


def _joined(parts: DataFrame, sep: str, chunk: tuple[int, int] | None) -> DataFrame:
    """Records that lie in several splits, under the split that they begin in."""
    parts = parts.where(F.col("kind") != _WHOLE)
    # At most two rows for each split: what an earlier one left open, and what it leaves open.
    before = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = F.when(F.col("kind") == _TAIL, F.struct(F.col("block").alias("of"), "row", "place"))
    owned = parts.select("file", "block", "value", F.last(begun, ignorenulls=True).over(before).alias("owner"))
    texts = F.array_sort(F.collect_list(F.struct("block", "value")))
    joined = owned.where("owner is not null").groupBy("file", "owner").agg(texts.alias("texts"))
    if chunk is not None:
        joined = joined.where((F.col("owner.place") >= chunk[0]) & (F.col("owner.place") < chunk[1]))
    value = F.array_join(F.transform("texts", lambda t: t["value"]), "\n")
    rows = joined.select(value.alias("value"), "file", F.col("owner.of").alias("block"), F.col("owner.row").alias("row"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_require_one_record(t.removesuffix("\r"), sep) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), *batch.columns[1:]], batch.schema.names)

    return rows.mapInArrow(check, "value string, file string, block long, row long")


def _overlapping(lines: DataFrame, found: Layout, low: int, high: int) -> DataFrame:
    """The lines of the splits that hold records of these places, and of those that such a record goes on in."""
    splits = [(f, b, *at) for f, blocks in found.splits.items() for b, at in blocks.items()]
    ends = [place for *_, place in splits[1:]] + [found.records]
    held = [k for k, (split, end) in enumerate(zip(splits, ends)) if split[3] < high and end > low]
    if not held:
        return lines.where(F.lit(False))
    first, last = held[0], held[-1]
    while last + 1 < len(splits) and splits[last + 1][2] == 1:
        last += 1
    # Both columns in one condition, as one on files alone would change the sizes of the splits.
    at = F.struct("file", "block")
    ends = [F.struct(F.lit(f).alias("file"), F.lit(b).cast("long").alias("block")) for f, b, *_ in (splits[first], splits[last])]
    return lines.where((at >= ends[0]) & (at <= ends[1]))
