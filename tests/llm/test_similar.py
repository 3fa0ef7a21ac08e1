"""The signature-tree join against comparing every two sets."""

import random

import numpy as np
import pytest

from tidemark.llm import signature_tree
from tidemark.llm.minhash import shingles
from tidemark.llm.signature_tree import Nodes, bitmap, dual_traversal, similar_classes


def brute_force(docs, size=5, percent=80) -> list[tuple]:
    sets = {}
    for doc, text in docs:
        words = (text or "").encode().lower().split()
        n = min(size, len(words))
        sets[doc] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                one, other = sorted((find(a), find(b)))
                root[other] = one
    return sorted(((d, len(s), find(d)) for d, s in sets.items()), key=repr)


def found_rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def families(seed: int, n: int, of: int, words: int):
    """Families of near copies with a few words changed, more or fewer than a link allows."""
    draw = random.Random(seed)
    docs = []
    for f in range(n):
        base = [f"w{draw.randrange(4000)}" for _ in range(draw.randint(words // 2, words))]
        for _ in range(draw.randint(1, of)):
            copy = list(base)
            for _ in range(draw.randint(0, 1 + words // 60)):
                copy[draw.randrange(len(copy))] = f"x{draw.randrange(10**6)}"
            docs.append(" ".join(copy))
    draw.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize(("seed", "block", "percent"), [(1, 1024, 80), (2, 3, 80), (3, 2, 90), (4, 1024, 100), (5, 4, 50)])
def test_families(spark, seed, block, percent):
    docs = families(seed, 25, 9, 150)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    assert found_rows(similar_classes(df, percent=percent, block=block)) == brute_force(docs, percent=percent)


def test_chain_over_blocks(spark):
    """Each document is linked with the next one only, so components need every link."""
    words = [f"w{k}" for k in range(400)]
    docs = [(100 - k, " ".join(words[8 * k : 8 * k + 100])) for k in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found_rows(similar_classes(df, block=2)) == brute_force(docs)


def test_passage_of_many(spark):
    """A passage shared by many unlike documents links nothing."""
    draw = random.Random(6)
    passage = " ".join(f"p{k}" for k in range(150))
    docs = [(k, " ".join(f"o{draw.randrange(10**7)}" for _ in range(40)) + " " + passage) for k in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found_rows(similar_classes(df)) == brute_force(docs)


def test_odd_documents(spark, odd_docs, no_docs):
    found = found_rows(similar_classes(odd_docs))
    assert len(found) == odd_docs.count()
    by_id = {}
    for doc, n, component in found:
        by_id.setdefault(doc, set()).add((n, component))
    assert by_id[5] == {(1, 3)} and by_id[3] == {(1, 3)}
    assert by_id[9] == {(0, 9)} and by_id[7] == {(0, 7)} and by_id[8] == {(0, 8)}
    assert by_id[20] == by_id[21] and {c for _, c in by_id[22]} == {20}
    assert by_id[None] == {(1, None)}
    assert found_rows(similar_classes(no_docs)) == []


def test_tree_keeps_every_link():
    draw = np.random.default_rng(7)
    sets = []
    for _ in range(40):
        base = draw.integers(0, 1 << 63, draw.integers(20, 120)).astype(np.uint64)
        for _ in range(draw.integers(1, 5)):
            copy = base.copy()
            copy[: draw.integers(0, len(base) // 6)] += np.uint64(1)
            sets.append(np.unique(copy))
    sets.sort(key=len)
    width = min(len(bitmap(s)) for s in sets)
    bits = np.stack([signature_tree._folded(bitmap(s), width) for s in sets])
    tree = Nodes.leaves(bits, np.array([len(s) for s in sets]), np.arange(len(sets))).tree()
    assert len(tree) > 2 and len(tree[-1]) == 1
    for level, below in zip(tree[1:], tree):
        for k in range(len(below)):
            assert not (below.bits[k] & ~level.bits[k // 8]).any()
            assert level.least[k // 8] <= below.least[k] and below.most[k] <= level.most[k // 8]
    found = {(i, j) for a, b, _ in dual_traversal(tree, None, 80) for i, j in zip(a, b)}
    assert all(i < j for i, j in found) and len(found) < len(sets) ** 2 / 8
    for i, a in enumerate(sets):
        for j in range(i + 1, len(sets)):
            common = len(np.intersect1d(a, sets[j]))
            if 100 * common >= 80 * (len(a) + len(sets[j]) - common):
                assert (i, j) in found


def test_copies_in_many_batches_and_repeated_identifiers(spark):
    """One text under many identifiers is one node; an identifier of two texts has the links of both."""
    base = [f"w{k}" for k in range(60)]
    near, far = [*base[:-1], "x"], [f"v{k}" for k in range(60)]
    docs = [(k, " ".join(base)) for k in range(300)] + [(900, " ".join(near)), (901, " ".join(far)), (901, " ".join(near))]
    docs += [(902, " ".join([*far[:-1], "y"]))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(9)
    assert {c for _, _, c in found_rows(similar_classes(df))} == {0}


def test_frequent_shingles_are_joined_by_rows(spark):
    """Families so large that their shingles are found frequent."""
    draw = random.Random(8)
    docs = []
    for f in range(4):
        base = [f"f{f}w{k}" for k in range(80)]
        for _ in range(120):
            copy = list(base)
            for _ in range(draw.randint(0, 3)):
                copy[draw.randrange(80)] = f"x{draw.randrange(10**6)}"
            docs.append((len(docs), " ".join(copy)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert len(signature_tree._frequent(df.selectExpr("doc_id id", "text"), 5)[0]) > 0
    assert found_rows(similar_classes(df, block=16)) == brute_force(docs)


def test_bitmaps_fold():
    hashes = shingles(" ".join(f"w{k}" for k in range(300)))
    full = bitmap(hashes)
    assert 2 * len(hashes) <= 64 * len(full) < 4 * len(hashes) + 64
    small = np.zeros(len(full) * 16, bool)
    small[(hashes & np.uint64(len(full) * 16 - 1)).astype(np.int64)] = True
    assert (signature_tree._folded(full, len(full) // 4) == np.packbits(small).view(np.uint64)).all()


def test_short_sets_below_the_threshold_are_told_apart():
    """Each pair shares 34 of 46 shingles: few of a group's pairs are left to confirm, all of the linked ones."""
    draw = np.random.default_rng(12)
    base = draw.integers(0, 1 << 63, 34).astype(np.uint64)
    sets = [np.unique(np.append(base, draw.integers(0, 1 << 63, 6).astype(np.uint64))) for _ in range(200)]
    sets.append(sets[0])
    bits = np.stack([bitmap(s) for s in sets])
    tree = Nodes.leaves(bits, np.array([len(s) for s in sets]), np.arange(len(sets))).tree()
    found = {(i, j) for a, b, _ in dual_traversal(tree, None, 80) for i, j in zip(a, b)}
    assert (0, 200) in found and len(found) < len(sets) ** 2 / 200


def test_rarer_shingles_are_frequent_where_they_fit(spark, monkeypatch):
    """Those found least often that still fit come last, whatever the number of occurrences; never more than the bound."""
    monkeypatch.setattr(signature_tree, "_SAMPLE", 1)
    monkeypatch.setattr(signature_tree, "FREQUENT", 100)
    draw = random.Random(14)

    def text(shared):
        return " ".join(f"o{draw.randrange(10**9)}" for _ in range(60)) + " " + " ".join(f"{shared}{k}" for k in range(5))

    # 20 shingles that six documents share, and with 150 more that four share too many; some 45,000 occurrences.
    six, four = [text(f"s{f}w") for f in range(20) for _ in range(6)], [text(f"f{f}w") for f in range(150) for _ in range(4)]
    for texts, of in ((six + [text("a") for _ in range(2)], 20), (six + four, 20), (four[:320] + six, 100)):
        df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(4)
        assert len(signature_tree._frequent(df, 5)[0]) == of
    docs = list(enumerate([*six, *six[:30], *four[:60]]))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert found_rows(similar_classes(df, block=16)) == brute_force(docs)
