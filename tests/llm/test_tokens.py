import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tidemark.llm.bpe import ByteBpe
from tidemark.llm.packing import SumOfSquares, pack
from tidemark.llm.queries import tokenizer_file
from tidemark.llm.token_files import read_token_files, write_token_files
from tidemark.llm.unigram import UnigramCounter, count_tokens, read_vocabulary

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(tokenizer_file("byte_bpe_50k.json"))


def _plain(bpe, text):
    return bpe.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_tokenizers(bpe):
    rng = random.Random(0)
    odd = ["", None, "a b  c", "x\n\n b", "x\n y", "\x1c!\x1c! a", "<|endoftext|> a\n <|endoftext|>", "a\r\n\r\nb", "it's  I'm", "été,-a  -,b"]
    signs = ["a", "b", " ", "é", ",", ".", "\n", "\t", "\x1c", "\x85", "'s", "1", "²", "_", "-", "　", "ß", "中", " ", "The"]
    texts = odd + ["".join(rng.choice(signs) for _ in range(rng.randrange(15))) for _ in range(3000)]
    for text, ids in zip(texts, bpe.encode(texts), strict=True):
        assert ids.tolist() == _plain(bpe, text), repr(text)


def test_token_files(spark, bpe, odd_docs, no_docs, tmp_path):
    path = str(tmp_path / "tokens")
    parts = write_token_files(odd_docs, path, tokenizer_file("byte_bpe_50k.json"), end_id=0)
    assert {r.id_bytes for r in parts.collect()} == {2}
    found = read_token_files(spark, path).orderBy("start").collect()
    given = sorted(((r.doc_id, r.text or "") for r in odd_docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in found] == [d for d, _ in given]
    start = 0
    for r in found:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert (r.start, r.n_tokens, ids[-1]) == (start, len(ids), 0)
        start += len(ids)
    expected = sorted(_plain(bpe, t) + [0] for _, t in given)
    assert sorted(np.frombuffer(bytes(r.ids), "<u4").tolist() for r in found) == expected
    # The files themselves: offsets are those of the whole folder.
    for part in parts.collect():
        offsets = np.fromfile(f"{path}/{part.name}.offsets", "<i8")
        assert offsets[0] == part.tokens_before and offsets[-1] - offsets[0] == part.tokens
        assert np.fromfile(f"{path}/{part.name}.ids", "<u2").size == part.tokens
    empty = str(tmp_path / "none")
    write_token_files(no_docs, empty, tokenizer_file("byte_bpe_50k.json"))
    assert read_token_files(spark, empty).count() == 0


def test_sum_of_squares_by_definition():
    """Every placement is a least one, and everything comes out once."""
    rng = random.Random(8)
    packer, size = SumOfSquares(32), 32
    out, given = [], {}
    for doc in range(800):
        ids = np.arange(rng.choice([1, 5, 31, 32, 33, 70, rng.randrange(1, 90)]))
        given[doc] = len(ids)
        before = packer.level.copy()
        out += packer.place(doc, ids)
        rest = len(ids) % size
        if rest:
            def square(level):
                return int((level[1:size] ** 2).sum())

            options = []
            for h in range(0, size - rest + 1):
                if h == 0 or before[h]:
                    level = before.copy()
                    level[h] -= 1 if h else 0
                    level[h + rest] += 1 if h + rest < size else 0
                    options.append(square(level))
            assert square(packer.level) == min(options)
    out += packer.close()
    _check_pieces([(doc, start, ids, total, s, o) for s, o, (doc, start, ids, total) in out], size, 1)
    lengths = {}
    for _, _, (doc, _, ids, total) in out:
        lengths[doc] = lengths.get(doc, 0) + len(ids)
        assert total == given[doc]
    assert lengths == given


def test_open_windows_are_bounded():
    """Documents that do not fit together leave a window each; before they hold too many ids they are filled up."""
    packer, out = SumOfSquares(64, most=2000), []
    for doc in range(1000):
        out += packer.place(doc, np.arange(40))
        assert packer.held == sum(len(p[2]) for level in packer.open for w in level for p in w) <= 2000 + 40
    out += packer.close()
    pieces = [(doc, start, ids, total, s, o) for s, o, (doc, start, ids, total) in out]
    _check_pieces(pieces, 64, 1000 * 40 // 2000 + 1)
    assert sum(len(p[2]) for p in pieces) == 40_000


def _check_pieces(pieces, size, partitions):
    windows = {}
    for doc, start, ids, _, sequence, offset in pieces:
        windows.setdefault(sequence, []).append((offset, len(ids)))
    short = 0
    for parts in windows.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= size
        short += end < size
    assert short <= partitions


def test_packing(spark, bpe, odd_docs, no_docs, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").repartition(3)
    pieces = [
        (r.doc_id, r.start, np.frombuffer(bytes(r.ids), "<u4"), r.doc_tokens, r.sequence_id, r.offset)
        for r in pack(docs, tokenizer_file("byte_bpe_50k.json"), 512).collect()
    ]
    _check_pieces(pieces, 512, 3)
    by_doc = {}
    for doc, start, ids, total, _, _ in sorted(pieces, key=lambda p: (p[0], p[1])):
        assert start == len(by_doc.setdefault(doc, []))
        by_doc[doc] += ids.tolist()
        assert total >= len(by_doc[doc])
    assert by_doc == {r.doc_id: _plain(bpe, r.text) + [1] for r in docs.collect()}
    odd = pack(odd_docs, tokenizer_file("byte_bpe_50k.json")).collect()
    expected = sum(len(_plain(bpe, r.text)) + 1 for r in odd_docs.collect())
    assert sum(r.length for r in odd) == expected and {r.doc_tokens for r in odd if r.doc_id == 9} == {1}
    assert pack(no_docs, tokenizer_file("byte_bpe_50k.json")).count() == 0


def _library(vocabulary, byte_fallback):
    model = tokenizers.models.Unigram(vocabulary, unk_id=0, byte_fallback=byte_fallback)
    found = tokenizers.Tokenizer(model)
    found.pre_tokenizer = tokenizers.pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=False)
    return found


def test_counts_of_a_public_vocabulary():
    vocabulary = read_vocabulary(tokenizer_file("piece_bpe_32k.model"))
    counter, library = UnigramCounter(vocabulary, 0, True), _library(vocabulary, True)
    assert counter.by_word
    rng = random.Random(3)
    signs = ["a", "b", "the", "ing", " ", "  ", "\n", "é", "ß", "中", "😀", "<unk>", "<s>", "<0x0A>", "▁", ".", "1", "\t", "ت", "⁂"]
    for text in ["", *["".join(rng.choice(signs) for _ in range(rng.randrange(13))) for _ in range(3000)]]:
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_counts_with_ties():
    """Small vocabularies with equal and fractional scores, counted as whole texts."""
    rng = random.Random(4)
    for _ in range(60):
        pieces = {"<unk>": 0.0}
        for _ in range(12):
            pieces["".join(rng.choice("ab▁c") for _ in range(rng.randrange(1, 5)))] = rng.choice([-1.0, -1.5, -2.0, -3.1])
        vocabulary = list(pieces.items())
        counter, library = UnigramCounter(vocabulary, 0, False), _library(vocabulary, False)
        for _ in range(40):
            text = "".join(rng.choice("abcd ") for _ in range(rng.randrange(15)))
            assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_counted_rows(spark, odd_docs, no_docs):
    found = count_tokens(odd_docs, tokenizer_file("piece_bpe_32k.model"))
    assert found.count() == odd_docs.count()
    assert {(r.doc_id, r.n_tokens) for r in found.where(F.col("doc_id").isin(7, 9)).collect()} == {(7, 0), (9, 0)}
    assert count_tokens(no_docs, tokenizer_file("piece_bpe_32k.model")).count() == 0
