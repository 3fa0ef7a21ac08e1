"""Token counts of a unigram tokenizer, without making the tokens.

An Aho-Corasick automaton lists every place where a piece of the vocabulary ends; the
Viterbi recursion over these places carries the best score and the number of pieces on the
way. Ties follow the tokenizers library's unigram model: a later candidate must score
strictly more, candidates come in the order of their starts, and an unknown character is
tried last, and only where no piece of one character stands.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.shared import ship

#: The sign that stands for a space, and what an unknown character scores below the worst piece.
SPACE, UNKNOWN_PENALTY = "▁", 10.0
#: Words whose counts a Python worker remembers.
REMEMBERED = 1_000_000
_SEGMENTS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class UnigramCounter:
    """Counts the tokens of texts under ``vocabulary``, a list of (piece, score).

    Spaces become ``SPACE``, and a text that does not begin with one gets one in front. Unknown
    characters next to each other are one token, or with ``byte_fallback`` one per byte
    if the vocabulary has a piece ``<0xHH>`` for each.
    """

    def __init__(self, vocabulary: list[tuple[str, float]], unk_id: int = 0, byte_fallback: bool = False):
        self.pieces, self.unk_id = {piece: k for k, (piece, _) in enumerate(vocabulary)}, unk_id
        self.bytes = {b for b in range(256) if f"<0x{b:02X}>" in self.pieces} if byte_fallback else set()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, k in self.pieces.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), vocabulary[k][1], k))
        self.automaton.make_automaton()
        # Words can be counted one by one if no piece reaches over the start of one, and
        # if sums of scores are exact in any order, as those of integers are.
        self.by_word = (
            SPACE in self.pieces
            and not any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.pieces)
            and all(score == int(score) and abs(score) < 1 << 30 for _, score in vocabulary)
        )
        self.known: dict[str, int] = {}

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        text = text.replace(" ", SPACE)
        if text[0] != SPACE:
            text = SPACE + text
        if not self.by_word:
            return self._viterbi(text)
        words = _SEGMENTS.findall(text)
        counts = list(map(self.known.get, words))
        if None not in counts:
            return sum(counts)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        for k, word in enumerate(words):
            if counts[k] is None:
                counts[k] = self.known[word] = self._viterbi(word)
        return sum(counts)

    def _run(self, unknown: str) -> int:
        """Tokens of a run of unknown characters."""
        if unknown in self.pieces:
            return 1
        data = unknown.encode("utf-8", "surrogatepass")
        return len(data) if self.bytes and self.bytes.issuperset(data) else 1

    def _viterbi(self, text: str) -> int:
        size, pieces, unk_id, unknown = len(text), self.pieces, self.unk_id, self.unknown
        # For each place: best score, tokens before the run of unknowns that ends here, start of that run or -1.
        best, tokens, runs = [0.0] * (size + 1), [0] * (size + 1), [-1] * (size + 1)
        matches = self.automaton.iter(text)
        at, match = next(matches, (size, None))
        for end in range(size):
            score, start, piece = None, 0, 0
            while at == end:
                length, own, k = match
                begin = end + 1 - length
                candidate = best[begin] + own
                if score is None or candidate > score:
                    score, start, piece = candidate, begin, k
                at, match = next(matches, (size, None))
            if text[end] not in pieces and (score is None or best[end] + unknown > score):
                score, start, piece = best[end] + unknown, end, unk_id
            best[end + 1] = score
            run = runs[start]
            if piece == unk_id:
                tokens[end + 1] = tokens[start]
                runs[end + 1] = run if run >= 0 else start
            else:
                tokens[end + 1] = tokens[start] + 1 + (self._run(text[run:start]) if run >= 0 else 0)
        return tokens[size] + (self._run(text[runs[size] :]) if runs[size] >= 0 else 0)


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(k), model.get_score(k)) for k in range(model.get_piece_size())]


@lru_cache(maxsize=4)
def _counter(path: str, unk_id: int, byte_fallback: bool) -> UnigramCounter:
    return UnigramCounter(read_vocabulary(path), unk_id, byte_fallback)


def count_tokens(
    df: DataFrame,
    vocabulary: str,
    unk_id: int = 0,
    byte_fallback: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col, n_tokens, n_chars`` of every row, by the pieces and scores of a sentencepiece file.

    The file's scores are used as those of a unigram model, whatever it was trained as. Null
    and empty texts have no tokens. Rows are counted one by one: null or repeated identifiers
    stay as they are, further columns play no part, an empty table gives an empty result.
    """
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary, unk_id, byte_fallback)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_pydict(
                {
                    id_col: batch.column(0),
                    "n_tokens": pa.array([counter.count(t) for t in texts], pa.int64()),
                    "n_chars": pa.array([len(t or "") for t in texts], pa.int64()),
                }
            )

    rows = df.selectExpr(f"cast(`{id_col}` as long) id", f"`{text_col}` text")
    return rows.mapInArrow(run, f"`{id_col}` long, n_tokens long, n_chars long")
