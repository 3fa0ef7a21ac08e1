import hashlib
import random
import re

import pytest
import xxhash
from tidemark.llm import suffix_array, substring_dedup
from tidemark.llm.chunk_dedup import Cuts, cut_points, drop_chunks, runs
from tidemark.llm.components import components
from tidemark.llm.exact_dedup import drop_copies, mark_copies
from tidemark.llm.minhash import drop_near_duplicates, near_duplicates

import numpy as np
import pyarrow as pa


def _norm(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def _copies(rows):
    """Brute force: what mark_copies gives, as a sorted list."""
    groups = {}
    for doc, text in rows:
        groups.setdefault(_norm(text), []).append(doc)
    out = []
    for text, docs in groups.items():
        docs.sort(key=lambda d: (d is None, d or 0))
        keep = docs[0]
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(d, keep, len(docs), i == 0, sha) for i, d in enumerate(docs)]
    return sorted(out, key=repr)


def test_copies(spark, odd_docs, no_docs, rows):
    given = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert rows(mark_copies(odd_docs)) == _copies(given)
    kept = drop_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert rows(kept, "doc_id") == sorted([(r[0],) for r in _copies(given) if r[3]], key=repr)
    assert mark_copies(no_docs).count() == drop_copies(no_docs).count() == 0


def test_a_group_over_many_ranges(spark, rows):
    """Copies that fill several ranges whole, and neighbours that share their first characters."""
    rng = random.Random(3)
    start = "x" * 80
    texts = [start + "same"] * 700 + [start + f"{i}" for i in range(40)] + ["y", "y", "z"]
    given = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(given)
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(6)
    assert rows(mark_copies(df)) == _copies(given)
    assert drop_copies(df).count() == len(set(texts))


def test_components(spark, rows):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1040)]
    edges += [(2000, i) for i in range(2001, 2200)] + [(5, 5), (7, None)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "a long, b long")
    assert rows(components(df)) == sorted([(x, find(x)) for x in root], key=repr)
    assert components(df.limit(0)).count() == 0


def _near(given, percent):
    """Brute force: identifier, shingles, component and whether kept; identifiers are unique."""
    sets = {}
    for doc, text in given:
        w = (text or "").encode().lower().split()
        sets[doc] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    docs = sorted(sets)
    for i, a in enumerate(docs):
        for b in docs[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted([(d, len(sets[d]), find(d), find(d) == d) for d in docs], key=repr)


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(spark, rows, percent):
    """Variants around a text whose mutual links are missing, chains, and buckets left open."""
    rng = random.Random(percent)
    given, doc = [], 0
    for _ in range(12):
        words = [rng.choice("abcdefghij") * 2 + str(rng.randrange(60)) for _ in range(rng.randrange(4, 90))]
        for _ in range(rng.randrange(1, 9)):
            changed = list(words)
            for _ in range(rng.randrange(0, 3)):
                changed[rng.randrange(len(changed))] = f"new{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                words = changed  # a chain
            given.append((doc := doc + rng.randrange(1, 4), (" " if rng.random() < 0.5 else "\n").join(changed).upper()))
    rng.shuffle(given)
    given += [(1000, None), (1001, ""), (1002, "one two"), (1003, "ONE\ttwo"), (1004, "one two three four five")]
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    expected = _near(given, percent)
    assert rows(near_duplicates(df, percent=percent)) == expected
    assert rows(drop_near_duplicates(df, percent=percent), "doc_id") == sorted([(r[0],) for r in expected if r[3]], key=repr)


def test_near_duplicates_of_odd_rows(spark, odd_docs, no_docs, rows):
    found = rows(near_duplicates(odd_docs))
    assert len(found) == odd_docs.count()
    by_id = {r[0]: r for r in found if r[0] is not None}
    assert [r[2:] for r in found if r[0] is None] == [(None, True)] * 2
    assert by_id[5][1:] == (1, 3, False) and by_id[3][1:] == (1, 3, True)
    assert by_id[22][2] == by_id[21][2] == 20 and by_id[9][1:] == (0, 9, True)
    kept = drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 3
    assert near_duplicates(no_docs).count() == 0


def _cut(text, cuts):
    data, begin, out = text.encode(), 0, []
    for end in cut_points(data, cuts):
        out.append(data[begin:end])
        begin = end
    assert b"".join(out) == data
    return out


def test_cut_points():
    rng = random.Random(2)
    cuts = Cuts(32, 200, 6)
    text = "".join(rng.choice("abcdefgh éß中") for _ in range(6000))
    pieces = _cut(text, cuts)
    assert all(p.decode() for p in pieces) and max(map(len, pieces)) <= 200
    assert min(len(p) for p in pieces[:-1]) >= 32
    shifted = _cut("some words in front " + text, cuts)
    assert len(set(pieces) & set(shifted)) > 0.9 * len(pieces)
    assert cut_points(b"", cuts) == [] and cut_points(b"ab", cuts) == [2]
    with pytest.raises(ValueError):
        Cuts(8, 100)


def test_dropped_chunks(spark, odd_docs, no_docs, rows):
    rng = random.Random(4)
    passages = ["".join(rng.choice("abcdefghijklm nop") for _ in range(900)) for _ in range(3)]
    given = []
    for doc in range(40):
        own = "".join(rng.choice("qrstuvwxyz é") for _ in range(rng.randrange(400)))
        given.append((doc, own + rng.choice(passages) + own[::-1]))
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(4)
    seen, expected, cuts = set(), [], Cuts()
    for doc, text in sorted(given):
        left, pieces = b"", _cut(text, cuts)
        for p in pieces:
            if p not in seen:
                left += p
            seen.add(p)
        size = len(text.encode())
        expected.append((doc, len(pieces), size, size - len(left), left.decode()))
    found = rows(drop_chunks(df), "doc_id", "n_chunks", "n_bytes", "n_removed", "text")
    assert found == sorted(expected, key=repr)
    assert sum(r[3] for r in found) > 15_000
    odd = {r.doc_id: r for r in drop_chunks(odd_docs).collect()}
    assert odd[9].n_chunks == odd[7].n_chunks == 0 and odd[9].text == "" and odd[None].n_removed == 0
    assert odd[21].n_removed == odd[21].n_bytes > 0 and odd[21].first_docs == [20] and odd[9].first_docs == []
    assert drop_chunks(no_docs).count() == 0


def test_suffix_arrays():
    rng = random.Random(6)
    for _ in range(150):
        parts = [[rng.randrange(rng.choice([2, 3, 5])) + 2 for _ in range(rng.randrange(13))] for _ in range(rng.randrange(1, 7))]
        symbols = [s for p in parts for s in [*p, suffix_array.PART_END]] + [suffix_array.END]
        found = suffix_array.suffix_array(np.array(symbols, np.uint16)).tolist()
        assert found == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def _repeats(given, length=50):
    """Brute force: identifier, bytes, bytes removed, runs, and what is left."""
    first, out = {}, []
    for doc, text in sorted(given):
        data = (text or "").encode()
        covered, strings = [False] * len(data), []
        for k in range(len(data) - length + 1):
            strings.append(data[k : k + length])
            if first.get(strings[-1], doc) < doc:
                covered[k : k + length] = [True] * length
        for s in strings:
            first.setdefault(s, doc)
        runs = sum(c and not b for c, b in zip(covered, [False, *covered], strict=False))
        out.append((doc, len(data), sum(covered), runs, bytes(b for b, c in zip(data, covered, strict=True) if not c)))
    return out


@pytest.mark.parametrize("crowded", [65_536, 3])
def test_repeats(spark, monkeypatch, crowded):
    monkeypatch.setattr(substring_dedup, "_CROWDED", crowded)
    monkeypatch.setattr(substring_dedup, "_RANGE", 400)
    monkeypatch.setattr(substring_dedup, "_SHARD", 50)
    rng = random.Random(crowded)
    passages = ["".join(rng.choice("abcde é") for _ in range(n)) for n in (49, 50, 51, 60, 75, 130, 400)]
    given = []
    for doc in range(60):
        text = ""
        for _ in range(rng.randrange(5)):
            text += "".join(rng.choice("abcde fgh") for _ in range(rng.randrange(60)))
            passage = rng.choice(passages)
            begin = rng.randrange(0, 20)
            text += passage[begin if rng.random() < 0.5 else 0 :]
        given.append((doc * 3 - 20, text))
    given += [(1000, "ab" * 200), (1001, "ab" * 300), (1002, None), (1003, "a" * 49), (1004, "a" * 49), (1005, "a" * 50), (1006, "a" * 51)]
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(5)
    found = {r.doc_id: r for r in substring_dedup.drop_repeats(df).collect()}
    for doc, size, removed, runs, left in _repeats(given):
        r = found[doc]
        assert (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) == (size, removed, runs, left), doc


def test_repeats_of_odd_rows(spark, odd_docs, no_docs):
    found = substring_dedup.drop_repeats(odd_docs).collect()
    assert len(found) == odd_docs.count()
    by_id = {r.doc_id: r for r in found}
    assert by_id[9].n_bytes == by_id[7].n_removed == 0 and by_id[None].n_removed == 0
    assert by_id[21].n_removed == by_id[21].n_bytes and bytes(by_id[22].kept) == b" end"[-len(by_id[22].kept) :]
    assert by_id[20].n_removed == 0
    assert substring_dedup.drop_repeats(no_docs).count() == 0


def test_digests_are_those_of_the_library():
    """Digests go into stored tables, so their definition may not drift."""
    assert xxhash.xxh3_128_hexdigest(b"") == "99aa06d3014798d86001c324468d497f"


def test_short_passages_are_found(spark):
    """Passages of 51 to 69 words that two documents share; a phrase that all of them share stays."""
    rng = random.Random(51)

    def words(n):
        return " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(2, 8))) for _ in range(n))

    phrase, shared, given = "all rights reserved by the", {}, []
    for k in range(300):
        passage = words(rng.randrange(51, 70))
        shared[2 * k + 1] = len(passage)
        for doc in (2 * k, 2 * k + 1):
            given.append((doc, f"{words(rng.randrange(5, 90))} {phrase} {words(30)} {passage} {words(rng.randrange(5, 90))}"))
    given += [(1000 + k, f"{words(40)} {phrase} {words(40)}") for k in range(100)]
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r for r in drop_chunks(df, least_run=48).collect()}
    caught = [d for d in shared if found[d].n_removed and found[d].first_docs == [d - 1]]
    assert len(caught) >= 299
    assert sum(min(found[d].n_removed, n) for d, n in shared.items()) >= 0.75 * sum(shared.values())
    assert all(phrase in r.text and (d in shared or not r.n_removed) for d, r in found.items())


def test_runs_of_repeated_chunks():
    ends = [20, 40, 60, 80, 100]
    assert runs(ends, {(0, 20), (40, 20), (60, 20)}, 48) == []
    assert runs(ends, {(0, 20), (40, 20), (60, 20), (80, 20)}, 48) == [(2, 5)]
    assert runs(ends, {(0, 20), (20, 20), (80, 20)}, 40) == [(0, 2)]
    assert runs([5], {(0, 5)}, 48) == [(0, 1)] and runs([], {}, 48) == []


def test_hot_grams_stay_out_of_ranges(spark, monkeypatch):
    """A passage in every document and a gram with as many contexts: no range holds all their places."""
    monkeypatch.setattr(substring_dedup, "_HOT", 40)
    monkeypatch.setattr(substring_dedup, "_SAMPLE", 1)
    rng = random.Random(10)

    def own(n):
        return "".join(rng.choice("abcdefgh é") for _ in range(n))

    passage, word = own(90), "a phrase of some bytes that all have"
    given = [(doc, f"{own(40)}{passage}{own(60)}{word}{own(rng.randrange(80))}") for doc in range(200)]
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(20)
    found = {r.doc_id: r for r in substring_dedup.drop_repeats(df).collect()}
    for doc, size, removed, runs_, left in _repeats(given):
        r = found[doc]
        assert (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) == (size, removed, runs_, left), doc

    rows = df.selectExpr("doc_id id", "text")
    hot = substring_dedup._hot(rows, 1, 40, 50, 20)
    assert len(hot) > 1
    blobs = substring_dedup._selected(rows, 4, 40, 50, 20, hot).collect()
    opened = [substring_dedup._unpack(b.blob)[0] for b in blobs if b.range < 4]
    keys, n = np.unique(np.concatenate(opened), return_counts=True)
    assert n.max() < 40 and not set(keys.tolist()) & set(hot.tolist())
    assert all(not len(substring_dedup._unpack(b.blob)[4]) for b in blobs if b.range < 4)
    assert sum(len(substring_dedup._unpack(b.blob)[4]) for b in blobs if b.range >= 4) > 200


@pytest.mark.parametrize("least_run", [0, 48])
def test_chunk_runs_by_brute_force(spark, rows, least_run):
    """What the registered query drops: runs of adjacent repeated chunks, found with plain loops."""
    rng = random.Random(21)
    words = ["".join(rng.choices("abcdefgh é", k=rng.randint(2, 9))) for _ in range(80)]
    passages = [" ".join(rng.choices(words, k=40)) for _ in range(5)]
    docs = []
    for k in range(60):
        parts = [" ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice(passages))
        docs.append((k * 7 % 60, " ".join(parts) if k % 9 else rng.choice(passages)))
    cuts, first = Cuts(), {}
    table = {}
    for doc, text in sorted(docs):
        data, begin, own = text.encode(), 0, []
        for end in cut_points(data, cuts):
            own.append((begin, end, data[begin:end]))
            begin = end
        table[doc] = own
    for doc in sorted(table):
        for begin, _, chunk in table[doc]:
            first.setdefault(chunk, (doc, begin))
    expected = []
    for doc, own in table.items():
        kept, k, dropped = [], 0, 0
        while k < len(own):
            after = k
            while after < len(own) and first[own[after][2]] != (doc, own[after][0]):
                after += 1
            if after > k and (own[after - 1][1] - own[k][0] >= least_run or after - k == len(own)):
                dropped += after - k
                k = after
                continue
            after = max(after, k + 1)
            kept += [c for _, _, c in own[k:after]]
            k = after
        left = b"".join(kept)
        size = own[-1][1] if own else 0
        expected.append((doc, len(own), dropped, size, size - len(left), left.decode()))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = rows(drop_chunks(df, least_run=least_run), "doc_id", "n_chunks", "n_dropped", "n_bytes", "n_removed", "text")
    assert found == sorted(expected, key=repr)
    assert any(r[4] for r in found)


def test_ranges_hold_alike_many_grams(spark):
    """Grams are selected for their small hashes, so ranges of one width would not."""
    rng = random.Random(7)
    given = [(k, "".join(rng.choices("abcdefghijklmnop ", k=20_000))) for k in range(20)]
    rows = spark.createDataFrame(given, "id long, text string")
    for ranges in (2, 16):
        blobs = substring_dedup._selected(rows, ranges, 40, 50, 20, np.empty(0, np.uint64)).collect()
        sizes = np.zeros(ranges)
        for b in blobs:
            sizes[b.range] += len(substring_dedup._unpack(b.blob)[0])
        assert sizes.sum() > 20_000 and sizes.max() < 1.15 * sizes.mean()


def test_texts_are_taken_in_parts():
    """A batch of Spark's 10,000 rows is worked on a few texts at a time, so that results aren't held for all of them."""
    batch = pa.RecordBatch.from_pydict({"id": list(range(10_000)), "text": [f"text {k}" for k in range(10_000)]})
    parts = list(substring_dedup._parts(iter([batch, batch.slice(0, 0), batch.slice(9_999)])))
    assert max(p.num_rows for p in parts) <= 512
    assert pa.Table.from_batches(parts) == pa.Table.from_batches([batch, batch.slice(9_999)])


@pytest.mark.parametrize(("length", "gram"), [(50, 20), (31, 20), (27, 20), (20, 20)])
def test_contexts_that_cannot_repeat_stay_out(length, gram):
    """Most contexts of a gram have only some bytes beside it in common: no suffix array has to tell that."""
    rng = random.Random(length)
    room = length - gram
    contexts, key, at, docs = [], [], [], []
    for k in range(400):
        which = rng.randrange(8)
        around = random.Random(which)
        before, word, after = (bytes(around.choice(b"abcd") for _ in range(n)) for n in (room, gram, room))
        left, right = rng.randrange(room + 1), rng.randrange(room + 1)
        own = [bytes(rng.choice(b"wxyz") for _ in range(room - n)) for n in (left, right)]
        context = own[0] + before[room - left :] + word + after[:right] + own[1]
        begin = rng.randrange(room + 1) if k % 5 == 0 else 0
        contexts.append(context[begin:])
        key.append(which - 4)
        at.append(room - begin)
        docs.append(rng.randrange(50))
    found = substring_dedup.may_repeat(contexts, *(np.array(x, np.int64) for x in (key, at, docs)), length, gram)

    def strings(k, size):
        """The strings of a context that hold its gram, with the gram and where it lies in them."""
        starts = range(max(0, at[k] + gram - size), min(at[k], len(contexts[k]) - size) + 1)
        return {(key[k], at[k] - s, contexts[k][s : s + size]) for s in starts}

    def shared(size):
        holders = {}
        for k in range(len(contexts)):
            for s in strings(k, size):
                holders.setdefault(s, set()).add(docs[k])
        return np.array([any(len(holders[s]) > 1 for s in strings(k, size)) for k in range(len(contexts))])

    assert not (shared(length) & ~found).any()
    assert not (found & ~shared(length - -(-room // 3))).any()
    assert length == gram or 0 < found.sum() < len(found)


def test_texts_are_hashed_together():
    """Grams are selected from neighbouring texts in one go; the texts stay apart."""
    rng = random.Random(12)
    texts = ["".join(rng.choices("ab é", k=rng.choice([0, 3, 19, 20, 49, 50, 51, 80, 300]))).encode() for _ in range(200)]
    text, at, hashes, digest = substring_dedup.select(texts)
    for k, data in enumerate(texts):
        _, *alone = substring_dedup.select([data])
        assert all((a == b[text == k]).all() for a, b in zip(alone, (at, hashes, digest), strict=True))
        own = {data[a : a + 20]: h for a, h in zip(at[text == k].tolist(), hashes[text == k].tolist())}
        # Every string of 50 bytes selects a gram, and short texts none.
        for a in range(len(data) - 49):
            assert any(data[p : p + 20] in own for p in range(a, a + 31))
        assert len(data) >= 50 or not own
    assert not len(substring_dedup.select([])[0]) and not len(substring_dedup.select([b"", b"a"])[0])
    pieces = list(substring_dedup._joined((k, "é" * 40_000) for k in range(5)))
    assert [p[0] for p in pieces] == [[0, 1], [2, 3], [4]] and sum(len(x) for p in pieces for x in p[1]) == 400_000


def test_a_lost_range_fails(spark, monkeypatch):
    """Selected places that come back without their range aren't left out silently."""
    kept = substring_dedup.keep

    def losing(df, label):
        df = kept(df, label)
        return df.selectExpr("if(range = 0, null, range) range", "blob") if label == "repeats-selected" else df

    rng = random.Random(3)
    passage = "".join(rng.choices("abcdefgh", k=90))
    df = spark.createDataFrame([(k, f"{k} {passage}") for k in range(4)], "doc_id long, text string")
    assert sum(r.n_removed > 80 for r in substring_dedup.drop_repeats(df).collect()) == 3
    monkeypatch.setattr(substring_dedup, "keep", losing)
    with pytest.raises(Exception, match="selected places without a range"):
        substring_dedup.drop_repeats(df).collect()
