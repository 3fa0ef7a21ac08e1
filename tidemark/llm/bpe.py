"""Byte-level BPE ids of whole texts, with a bounded memory of the words seen."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The characters that Unicode calls white space.
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Letters of the Latin blocks that words are mostly made of.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: A pre-tokenizer of the kind meant always cuts between these units.
_UNITS = re.compile(
    f" ?[{_LETTERS}]++(?=[{WHITE_SPACE},.;:!?]|\\Z)"
    f"| ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+"
)
_WORD = re.compile(f" ?[{_LETTERS}]+")
#: Bytes that a Python worker remembers units with, twice; and what one takes besides its letters and ids.
REMEMBERED, _BESIDES = 40 << 20, 150
#: Bytes of the texts that are encoded together.
_TOGETHER = 1 << 21


class Memory:
    """Ids of units, one after the other, and the place of each unit among them."""

    def __init__(self):
        self.places: dict[str, int] = {}
        self.ids, self.begins, self.lengths = np.empty(0, "<u4"), np.empty(0, np.int64), np.empty(0, np.int64)
        self.n_ids = self.letters = 0

    def size(self) -> int:
        return self.letters + 4 * self.n_ids + _BESIDES * len(self.places)

    def add(self, units: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        n, more = len(self.places), len(units)
        if n + more > len(self.begins):
            room = n // 2 + more
            self.begins = np.concatenate([self.begins[:n], np.empty(room, np.int64)])
            self.lengths = np.concatenate([self.lengths[:n], np.empty(room, np.int64)])
        if self.n_ids + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.n_ids], np.empty(self.n_ids // 2 + len(ids), "<u4")])
        self.begins[n : n + more] = self.n_ids + np.cumsum(lengths) - lengths
        self.lengths[n : n + more] = lengths
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.n_ids += len(ids)
        self.letters += sum(map(len, units))
        self.places.update(zip(units, range(n, n + more)))

    def at(self, units: list[str]) -> np.ndarray:
        """The places of the units; -1 for one that is not known."""
        return np.fromiter(map(self.places.get, units, repeat(-1)), np.int64, len(units))

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the units at these places, and the number of each."""
        lengths = self.lengths[places]
        return self.ids[_ranges(self.begins[places], lengths)], lengths


class ByteBpe:
    """Encodes texts to the very ids of ``Tokenizer.encode(text, add_special_tokens=False)``.

    A byte-level pre-tokenizer always cuts before a space that a word follows, between a word and
    other white space, and between a run of letters and the punctuation behind it. So texts are
    cut there, the units of a batch are told apart once, the distinct ones that are not
    remembered are encoded by the tokenizers library, and the ids of the texts are taken from
    those of the units. Texts that hold an added token, and tokenizers set up in any other way,
    are encoded whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            setup = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.added = [x["content"] for x in setup.get("added_tokens", [])]
        before = setup.get("pre_tokenizer") or {}
        self.by_unit = (
            setup.get("normalizer") is None
            and setup["model"]["type"] == "BPE"
            and not setup["model"].get("dropout")
            and (before.get("type"), before.get("add_prefix_space"), before.get("use_regex", True))
            == ("ByteLevel", False, True)
        )
        # What was not asked for while the younger memory filled up is forgotten with the older one.
        self.memory, self.older = Memory(), Memory()
        # The characters that a byte-level vocabulary has for the bytes.
        whole = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(whole)]
        self.characters = {b: b for b in whole} | {b: 256 + k for k, b in enumerate(rest)}

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text as unsigned 32-bit integers; a null text has none."""
        found: list[np.ndarray] = []
        for ids, lengths in self.encode_column(pa.array(texts, pa.string())):
            found += np.split(ids, np.cumsum(lengths)[:-1])
        return found

    def encode_column(self, texts: pa.Array):
        """Ids of stretches of the texts, one after the other, and the number of ids of each text.

        A stretch has some megabytes of texts, or one text.
        """
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < len(texts):
            before = sizes[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(sizes, before + _TOGETHER, side="right")))
            yield self._stretch(pc.fill_null(texts.slice(begin, end - begin).cast(pa.large_string()), ""))
            begin = end

    def _stretch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        whole = np.full(len(texts), not self.by_unit)
        for content in self.added:
            whole |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False).astype(bool)
        units: list[str] = []
        numbers = []
        for text in texts.filter(pa.array(~whole)).to_pylist():
            found = _UNITS.findall(text)
            units += found
            numbers.append(len(found))
        lengths, ids = self._units(units)
        upto = np.concatenate([[0], np.cumsum(lengths)])
        n_ids = np.zeros(len(texts), np.int64)
        n_ids[~whole] = np.diff(upto[np.concatenate([[0], np.cumsum(numbers)])])
        if not whole.any():
            return ids, n_ids
        others = self.tokenizer.encode_batch_fast(texts.filter(pa.array(whole)).to_pylist(), add_special_tokens=False)
        n_ids[whole] = [len(x.ids) for x in others]
        out = np.empty(int(n_ids.sum()), "<u4")
        begins = np.cumsum(n_ids) - n_ids
        out[_ranges(begins[~whole], n_ids[~whole])] = ids
        out[_ranges(begins[whole], n_ids[whole])] = np.concatenate([np.array(x.ids, "<u4") for x in others])
        return out, n_ids

    def _units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each unit, and all ids one after the other."""
        if self.memory.size() > REMEMBERED:
            self.memory, self.older = Memory(), self.memory
        places = self.memory.at(units)
        missing = np.flatnonzero(places < 0)
        if len(missing):
            names = [units[k] for k in missing.tolist()]
            distinct = list(dict.fromkeys(names))
            there = self.older.at(distinct)
            old = np.flatnonzero(there >= 0).tolist()
            if old:
                self.memory.add([distinct[k] for k in old], *self.older.take(there[old]))
            self.memory.add(*self._encoded([distinct[k] for k in np.flatnonzero(there < 0).tolist()]))
            places[missing] = self.memory.at(names)
        ids, lengths = self.memory.take(places)
        return lengths, ids

    def _encoded(self, units: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The units, words first, all their ids, and the number of each.

        Words go to the model straight, as the pre-tokenizer would hand them on; all else to the tokenizer.
        """
        is_word = [_WORD.fullmatch(unit) is not None for unit in units]
        words = list(compress(units, is_word))
        ids: list[int] = []
        ends = []
        if words:
            shown = "\n".join(words).encode().decode("latin-1").translate(self.characters)
            tokenize = self.tokenizer.model.tokenize
            for word in shown.split(chr(self.characters[10])):
                ids += [token.id for token in tokenize(word)]
                ends.append(len(ids))
        if len(words) < len(units):
            others = [unit for unit, word in zip(units, is_word) if not word]
            for found in self.tokenizer.encode_batch_fast(others, add_special_tokens=False):
                ids += found.ids
                ends.append(len(ids))
            words += others
        return words, np.array(ids, "<u4"), np.diff(np.array(ends, np.int64), prepend=0)


def _ranges(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``begin`` to ``begin + length``, one range after the other."""
    return np.repeat(begins - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))


@lru_cache(maxsize=4)
def byte_bpe(path: str) -> ByteBpe:
    """The encoder of a tokenizer file, one per Python worker."""
    return ByteBpe(path)
