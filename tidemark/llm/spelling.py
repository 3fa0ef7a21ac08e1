"""Spelling variants: pairs of words one edit apart, by composing finite-state machines.

The vocabulary is an acceptor, the edit a transducer that copies symbols, changes the text at
one place, and copies the rest. Composing acceptor, transducer and acceptor accepts the pairs
of words that one edit leads from one to the other. The work is dealt by initial states: all
words that agree outside a stretch of places are one group; the state after their common start
is the group's initial state, and its acceptor, minimised, is that of their stretches. A pair
is enumerated in the one group whose stretch holds its edit. Stretches are halves of words
first; those of crowded groups are halved again, down to one place, where a group is no larger
than the alphabet allows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import dealt_anew, keep, ship

_RUNS = re.compile("[a-zÀ-ÿ]+")
#: Words that a task adds up, and bytes of text it takes them from, before it passes counts on.
_ENTRIES, _BYTES = 250_000, 1 << 25
#: Words of a group that is not halved any more.
GROUP = 4096


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", slip_every: int | None = None) -> DataFrame:
    """``word, n``: how often each word occurs in the whole texts.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF; A-Z is lower-cased. With
    ``slip_every``, let h be the CRC-32 of ``<identifier>:<word>``; where ``slip_every`` divides h, the
    word lacks its code point h % length in this document (a null identifier is empty text).
    A word of which nothing is left is no word. Null texts have none; every row counts, also
    repeated ones and those without identifier.
    """
    ship(df.sparkSession)

    def table(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(total.keys(), pa.string()), "n": pa.array(total.values(), pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        size = 0
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for doc, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                found = _RUNS.findall((text.as_py() or b"").lower().decode())
                total.update(found)
                if slip_every:
                    before = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    slips = [word for word in set(found) if zlib.crc32(word.encode(), before) % slip_every == 0]
                    counts = Counter(found) if slips else {}
                    for word in slips:
                        at = zlib.crc32(word.encode(), before) % len(word)
                        total[word] -= counts[word]
                        total[word[:at] + word[at + 1 :]] += counts[word]
                size += len(text.as_buffer()) if text.is_valid else 0
                if len(total) > _ENTRIES or size > _BYTES:
                    yield table(total)
                    total.clear()
                    size = 0
        yield table(total)

    rows = df.selectExpr(f"cast(`{id_col}` as string) id", f"`{text_col}` text")
    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where("n > 0 and word != ''")


class Acceptor:
    """Minimised acyclic acceptors over one store of states.

    A state is its arcs and whether it accepts; equal states are one, so two states of one
    number accept the same texts.
    """

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.arcs: list[dict[str, int]] = []
        self.accepts: list[bool] = []
        self.common: dict[tuple[int, int], tuple[str, ...]] = {}

    def _state(self, arcs: dict[str, int], accepts: bool) -> int:
        name = (accepts, *arcs.items())
        found = self.known.get(name)
        if found is None:
            found = self.known[name] = len(self.arcs)
            self.arcs.append(arcs)
            self.accepts.append(accepts)
        return found

    def add(self, texts: list[str]) -> int | None:
        """The initial state of the acceptor of these sorted distinct texts; None for none."""
        if not texts:
            return None
        # States along the latest text that may still grow: arcs and whether they accept.
        growing: list[tuple[dict[str, int], bool]] = [({}, False)]
        latest = ""

        def settle(depth: int) -> None:
            while len(growing) > depth + 1:
                state = self._state(*growing.pop())
                growing[-1][0][latest[len(growing) - 1]] = state

        for text in texts:
            shared = 0
            for a, b in zip(latest, text):
                if a != b:
                    break
                shared += 1
            settle(shared)
            growing.extend(({}, False) for _ in range(len(text) - shared))
            growing[-1] = (growing[-1][0], True)
            latest = text
        settle(0)
        return self._state(*growing[0])

    def both(self, p: int, q: int) -> tuple[str, ...]:
        """Texts that both states accept."""
        name = (p, q) if p < q else (q, p)
        found = self.common.get(name)
        if found is None:
            texts, stack = [], [(p, q, "")]
            while stack:
                a, b, text = stack.pop()
                if self.accepts[a] and self.accepts[b]:
                    texts.append(text)
                more = self.arcs[b]
                stack += [(c, more[symbol], text + symbol) for symbol, c in self.arcs[a].items() if symbol in more]
            found = self.common[name] = tuple(texts)
        return found


def one_edit_pairs(short: list[str], long: list[str], at_end: bool) -> Iterator[tuple[str, str]]:
    """Pairs one edit apart: two of ``short`` by one replaced symbol, or one of ``short`` and, after
    it, one of ``long`` by an inserted one.

    All of ``short`` have one length, all of ``long`` one more. An insertion is placed as late as it
    can be (behind the longest common start); behind the last place it counts only ``at_end``.
    """
    store = Acceptor()
    p, q = store.add(sorted(short)), store.add(sorted(long))
    if p is None:
        return
    stack: list[tuple[int, int | None, str]] = [(p, q, "")]
    while stack:
        p, q, start = stack.pop()
        arcs, wide = store.arcs[p], store.arcs[q] if q is not None else {}
        symbols = list(arcs)
        for k, a in enumerate(symbols):
            for b in symbols[:k]:
                for rest in store.both(arcs[a], arcs[b]):
                    yield start + a + rest, start + b + rest
        for b, after in wide.items():
            if not arcs:
                if at_end:
                    yield start, start + b
                continue
            for rest in store.both(p, after):
                if rest[0] != b:
                    yield start + rest, start + b + rest
        # Copy one more symbol on both sides.
        stack += [(state, wide.get(symbol), start + symbol) for symbol, state in arcs.items()]


def _group_rows(words: list[str], counts: list[int], length: int, lo: int, hi: int) -> list[tuple[str, int, int, str]]:
    """``word, n_near, best_n, best`` of the words of one group that have a near one in it."""
    short: dict[str, int] = {}
    long: dict[str, int] = {}
    for k, word in enumerate(words):
        if len(word) == length:
            short[word[lo:hi]] = k
        else:
            long[word[lo : hi + 1]] = k
    found: dict[int, list] = {}

    def saw(one: int, other: int) -> None:
        n, word = counts[other], words[other]
        row = found.setdefault(one, [0, n, word])
        row[0] += 1
        if n > row[1] or (n == row[1] and word < row[2]):
            row[1:] = n, word

    for x, y in one_edit_pairs(list(short), list(long), hi == length):
        one, other = short[x], short[y] if len(y) == len(x) else long[y]
        saw(one, other)
        saw(other, one)
    return [(words[k], *row) for k, row in found.items()]


def _near(groups: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` for every group, from rows ``key, length, lo, hi, word, n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, words, counts, place, out = None, [], [], (0, 0, 0), []

        def table() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[], [], [], []]
            types = (pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["word", "n_near", "best_n", "best"]
            )

        for batch in batches:
            for key, length, lo, hi, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != last:
                    if len(words) > 1:
                        out += _group_rows(words, counts, *place)
                    last, words, counts, place = key, [], [], (length, lo, hi)
                words.append(word)
                counts.append(n)
            if len(out) > 10_000:
                yield table()
                out = []
        if len(words) > 1:
            out += _group_rows(words, counts, *place)
        yield table()

    rows = groups.repartition("key").sortWithinPartitions("key").select("key", "length", "lo", "hi", "word", "n")
    return rows.mapInArrow(run, "word string, n_near long, best_n long, best string")


def near_words(words: DataFrame, group: int = GROUP) -> DataFrame:
    """``word, n_near, best_n, best`` of all words that another one is one edit away from.

    ``words`` are distinct, as ``word, n``; an edit inserts, deletes or replaces one code point. ``n_near``
    counts the near words, ``best`` is the one of largest ``n`` (``best_n``), of ties the smallest in code-point
    order.
    """
    ship(words.sparkSession)
    # A word stands in groups for its own length and, as the longer one, for the next shorter.
    size = F.length("word")
    rows = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("length"))
    halves = F.array(
        F.struct(F.lit(0).alias("lo"), F.expr("length div 2").cast("int").alias("hi")),
        F.struct(F.expr("length div 2").cast("int").alias("lo"), F.col("length").alias("hi")),
    )
    rows = rows.select("word", "n", "length", F.inline(halves)).where("lo < hi")
    found = None
    while True:
        # What lies outside the stretch, and where it lies, names the group.
        outside = F.concat(
            F.concat_ws(":", "length", "lo", "hi").cast("string"), F.lit(":"), F.expr("left(word, lo)"), F.expr("right(word, length - hi)")
        )
        keyed = keep(rows.withColumn("key", F.unhex(F.md5(outside))), "spelling-stretches")
        own = (F.length("word") == F.col("length")).cast("long")
        sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.sum(own).alias("own"))
        sizes = sizes.where("members > 1 and own > 0").select("key", "members")
        named = keep(keyed.join(dealt_anew(sizes), "key"), "spelling-groups")
        crowded = (F.col("members") > group) & (F.col("hi") - F.col("lo") > 1)
        near = _near(named.where(~crowded))
        found = near if found is None else found.unionByName(near)
        again = named.where(crowded)
        if again.isEmpty():
            break
        middle = F.expr("(lo + hi) div 2").cast("int")
        halves = F.array(
            F.struct(F.col("lo"), middle.alias("hi")),
            F.struct(middle.alias("lo"), F.col("hi")),
        )
        rows = again.select("word", "n", "length", F.inline(halves))
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))).alias("first")
    totals = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return totals.select("word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the end of the chain of forms; every round doubles the steps made."""
    reached = keep(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = reached.join(ahead, "root", "left")
        step = step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        reached = keep(step, "spelling-roots")
        if reached.where("moved").isEmpty():
            return reached.select("word", "root")
        reached = reached.select("word", "root")


def variants(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = 5,
    least_count: int = 3,
    times: int = 2,
    slip_every: int | None = None,
    group: int = GROUP,
) -> DataFrame:
    """Every frequent word with the form it is a variant of: ``word, form, root, n, n_near, form_n``.

    Words are those of ``word_counts`` with at least ``least_length`` code points and ``least_count``
    occurrences (``n``). Two are near if one inserted, deleted or replaced code point leads from
    one to the other. ``form`` is the near word of largest ``n`` (of ties the smallest in code-point
    order) if that ``n`` (``form_n``) is at least ``times`` the word's own, else null; ``root`` is where forms
    lead to, the word itself without one; ``n_near`` counts near words. ``times`` is 2 or more.
    Null and empty texts have no words; an empty table gives an empty result; further columns
    play no part. A word of any length is a word.
    """
    if times < 2:
        raise ValueError("forms end at a root only if each is more frequent than the last")
    counted = word_counts(df, id_col, text_col, slip_every)
    words = keep(counted.where((F.length("word") >= least_length) & (F.col("n") >= least_count)), "spelling-words")
    near = words.join(near_words(words, group), "word", "left")
    is_form = F.col("best_n") >= times * F.col("n")
    near = keep(
        near.select(
            "word",
            F.when(is_form, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "spelling-near",
    )
    roots = _roots(near.where("form is not null"))
    result = near.join(roots, "word", "left")
    return result.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
