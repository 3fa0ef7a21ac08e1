"""Suffix arrays by induced sorting, and common prefixes in text order, on numpy arrays.

A bucket is scanned in waves: all its suffixes found so far induce their predecessors at
once, predecessors in the same bucket being the next wave. So a scan takes a step for every
symbol and every round of a run, not one for every suffix.
"""

from __future__ import annotations

import numpy as np

#: Symbols: 0 ends the whole text, 1 ends a part, a byte b is b + 2.
END, PART_END, SYMBOLS = 0, 1, 258


def types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor (S type); the end is."""
    n = len(text)
    differs = np.flatnonzero(text[:-1] != text[1:])
    smaller = np.zeros(n, bool)
    smaller[-1] = True
    # Equal neighbours take the type of the end of their run.
    run_end = np.repeat(differs, np.diff(differs, prepend=-1))
    smaller[:-1] = text[run_end] < text[run_end + 1] if n > 1 else smaller[:-1]
    return smaller


def _induce(text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """All suffixes in order, induced from the leftmost smaller ones in the order given."""
    n = len(text)
    sizes = np.bincount(text, minlength=SYMBOLS)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    found = np.full(n, -1, np.int32)

    def put(items: np.ndarray, place: np.ndarray, step: int) -> None:
        symbols = text[items]
        order = np.argsort(symbols, kind="stable")
        items, symbols = items[order], symbols[order]
        counts = np.bincount(symbols, minlength=SYMBOLS)
        rank = np.arange(len(items)) - np.repeat(np.cumsum(counts) - counts, counts)
        found[place[symbols] + step * rank] = items
        place += step * counts

    # Larger suffixes, from small to large: after those found, the leftmost smaller of each bucket.
    heads = starts[:-1].copy()
    by_symbol = np.split(leftmost, np.cumsum(np.bincount(text[leftmost], minlength=SYMBOLS))[:-1])
    for symbol in np.flatnonzero(sizes):
        done = starts[symbol]
        while done < heads[symbol]:
            wave, done = found[done : heads[symbol]], int(heads[symbol])
            before = wave[wave > 0] - 1
            before = before[~smaller[before]]
            if len(before):
                put(before, heads, 1)
        before = by_symbol[symbol]
        before = before[before > 0] - 1
        if len(before):
            put(before, heads, 1)
    # Smaller suffixes, from large to small, each bucket from its end.
    tails = starts[1:] - 1
    for symbol in np.flatnonzero(sizes)[::-1]:
        done = starts[symbol + 1] - 1
        while done > tails[symbol]:
            wave = found[tails[symbol] + 1 : done + 1][::-1]
            done = int(tails[symbol])
            before = wave[wave > 0] - 1
            before = before[smaller[before]]
            if len(before):
                put(before, tails, -1)
        larger = found[starts[symbol] : heads[symbol]][::-1]
        before = larger[larger > 0] - 1
        before = before[smaller[before]]
        if len(before):
            put(before, tails, -1)
    found[0] = n - 1  # the end, which nothing induces
    return found


def _named(text: np.ndarray, leftmost: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Names of the leftmost-smaller substrings, which ``order`` lists sorted: equal ones alike."""
    ends = np.concatenate([leftmost[1:], leftmost[-1:]])
    at = np.searchsorted(leftmost, order)
    begin, length = order, ends[at] - order
    same = length[1:] == length[:-1]
    same &= text[begin[1:]] == text[begin[:-1]]
    left, offset = np.flatnonzero(same), 1
    while len(left):
        left = left[length[left] >= offset]
        differ = text[begin[left] + offset] != text[begin[left + 1] + offset]
        same[left[differ]] = False
        left, offset = left[~differ], offset + 1
    names = np.empty(len(leftmost), np.int64)
    names[at] = np.concatenate([[0], np.cumsum(~same)])
    return names


def _sorted_by_names(names: np.ndarray) -> np.ndarray:
    """The suffixes of the reduced string in order, by doubling of the names compared.

    A suffix's rank is the place of the first one not yet told apart from it; only those that
    share a rank are sorted again.
    """
    n, step = len(names), 1
    sizes = np.bincount(names)
    rank = (np.cumsum(sizes) - sizes)[names]
    tied = np.flatnonzero(sizes[names] > 1)
    while len(tied):
        following = np.full(len(tied), -1, np.int64)
        inside = tied + step < n
        following[inside] = rank[tied[inside] + step]
        key = rank[tied] * (n + 1) + following + 1
        order = np.argsort(key)
        tied, key, old = tied[order], key[order], rank[tied[order]]
        # Where each old group, and each new one, begins among the tied.
        places = np.arange(len(tied))
        new = np.append(True, key[1:] != key[:-1])
        group = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), places, 0))
        begin = np.maximum.accumulate(np.where(new, places, 0))
        rank[tied] = old + begin - group
        alone = new & np.append(new[1:], True)
        tied, step = tied[~alone], step * 2
    found = np.empty(n, np.int64)
    found[rank] = np.arange(n)
    return found


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Where the sorted suffixes of ``text`` begin; its last symbol, and no other, is ``END``."""
    if len(text) == 1:
        return np.zeros(1, np.int32)
    smaller = types(text)
    leftmost = (np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1).astype(np.int32)
    if not len(leftmost):
        leftmost = np.array([len(text) - 1], np.int32)
    if len(leftmost) > 1:
        # Induced from any order within the buckets, the leftmost smaller ones come sorted by substring.
        rough = _induce(text, smaller, leftmost[np.argsort(text[leftmost], kind="stable")])
        is_leftmost = np.zeros(len(text), bool)
        is_leftmost[leftmost] = True
        order = rough[is_leftmost[rough]]
        leftmost = leftmost[_sorted_by_names(_named(text, leftmost, order))]
    return _induce(text, smaller, leftmost)


def common_prefixes(text: np.ndarray, suffixes: np.ndarray, begins: np.ndarray, lengths: np.ndarray, most: int) -> np.ndarray:
    """For every position, the symbols its suffix has in common with the one sorted before it.

    Parts of the text lie at ``begins`` with ``lengths``. Positions are taken from left to right in
    all parts at once, since a position's value is at least its left neighbour's less one.
    Values stop at ``most``; positions fewer than ``most`` from the end of their part get 0.
    """
    before = np.empty(len(text), np.int64)
    before[suffixes[1:]] = suffixes[:-1]
    before[suffixes[0]] = -1
    found = np.zeros(len(text), np.int64)
    value = np.zeros(len(begins), np.int64)
    for offset in range(int(lengths.max(initial=0)) - most + 1):
        inside = np.flatnonzero(lengths - offset >= most)
        here = begins[inside] + offset
        there, size = before[here], np.maximum(value[inside] - 1, 0)
        growing = np.flatnonzero((there >= 0) & (size < most))
        while len(growing):
            ends = there[growing] + size[growing]
            growing, ends = growing[ends < len(text)], ends[ends < len(text)]
            growing = growing[text[here[growing] + size[growing]] == text[ends]]
            size[growing] += 1
            growing = growing[size[growing] < most]
        found[here] = size
        value[inside] = size
    return found
