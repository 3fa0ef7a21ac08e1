"""Spelling variants against comparing every two words."""

import random
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm.spelling import Acceptor, near_words, variants, word_counts


def one_apart(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_force(docs, slip_every=None, least_length=5, least_count=3, times=2) -> list[tuple]:
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if slip_every and h % slip_every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * n else None
    rows = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(rows, key=repr)


def found_rows(df) -> list[tuple]:
    columns = "word form root n n_near form_n".split()
    return sorted((tuple(r) for r in df.select(columns).collect()), key=repr)


def random_docs(seed: int, alphabet: str, lengths: range, n: int):
    draw = random.Random(seed)
    words = ["".join(draw.choice(alphabet) for _ in range(draw.choice(lengths))) for _ in range(n)]
    return [(k, " ".join(draw.choices(words, weights=range(1, n + 1), k=200))) for k in range(40)]


@pytest.mark.parametrize(("seed", "alphabet", "group"), [(1, "ab", 4096), (2, "abé", 4096), (3, "ab", 3), (4, "abcÿ", 2)])
def test_random_words(spark, seed, alphabet, group):
    docs = random_docs(seed, alphabet, range(4, 9), 150)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert found_rows(variants(df, slip_every=7, group=group)) == brute_force(docs, 7)


def test_hot_stretch(spark):
    """A start and an end that most words have: their groups are halved until they are small."""
    draw = random.Random(5)
    words = ["start" + "".join(draw.choice("abc") for _ in range(5)) + "ending" for _ in range(120)]
    docs = [(k, " ".join(words) + " " + " ".join(words[::2])) for k in range(3)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found_rows(variants(df, group=5)) == brute_force(docs)


def test_odd_texts(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert found_rows(variants(odd_docs, slip_every=3, least_length=1, least_count=1)) == brute_force(rows, 3, 1, 1)
    assert found_rows(variants(no_docs)) == []
    assert found_rows(variants(odd_docs, text_col="source")) == []


def test_long_words_and_marks(spark):
    long = "ab" * 20_000
    docs = [(1, f"{long} {long} {long}x ×÷ Ünder Under ünder"), (2, f"{long}x {long}X {long} a" + "b" * 7), (None, "under under under")]
    df = spark.createDataFrame([(*d, "x", "x", "x") for d in docs], "doc_id long, text string, word string, n string, length string")
    assert found_rows(variants(df, least_count=2)) == brute_force(docs, least_count=2)


def test_form_ties_and_chains(spark):
    docs = [(1, "grapes " * 20 + "grapez " * 20 + "grapey " * 5 + "grapyy " * 2 + "grbpyy")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.word: r for r in variants(df, least_count=1).collect()}
    assert found["grapey"].form == "grapes"  # of grapes and grapez the smaller
    assert found["grbpyy"].form == "grapyy" and found["grbpyy"].root == "grapes"
    assert found["grapes"].form is None and found["grapes"].root == "grapes"
    with pytest.raises(ValueError):
        variants(df, times=1)


def test_counts(spark):
    df = spark.createDataFrame([(1, "Ab ab aB"), (2, None)], "doc_id long, text string")
    assert [tuple(r) for r in word_counts(df).collect()] == [("ab", 3)]


def test_acceptor_is_minimal():
    store = Acceptor()
    start = store.add(sorted(a + b for a in "abc" for b in "xyz"))
    assert len(store.arcs) == 3  # start, after one symbol, end
    assert sorted(store.both(start, start)) == sorted(a + b for a in "abc" for b in "xyz")
    assert store.add([]) is None


def test_near_words_of_no_words(spark):
    assert near_words(spark.createDataFrame([], "word string, n long")).count() == 0
