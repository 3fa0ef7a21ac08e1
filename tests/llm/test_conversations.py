"""The prefix trie of conversations against a trie built turn by turn."""

import hashlib
import random
import zlib

import pytest

from tidemark.llm.prefix_trie import prefix_trie, rebuilt, turn_keys

SCHEMA = "conv_id long, turn long, role string, text string, depth string, path string, key string, low string"


def brute_force(convs: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    members: dict[tuple, list[int]] = {}
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    rows = []
    for node, inside in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[: len(n)] == n and len(m) > len(n) for m in below)]
        saved = sum((len(members[n]) - 1) * (len(n[-1][1]) if n else 0) for n in below)
        ends = ",".join(str(c) for c in sorted(inside) if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        rows.append(
            (min(inside), len(node), parent, len(inside), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(rows, key=repr)


def trie_rows(df) -> list[tuple]:
    columns = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted((tuple(r) for r in df.select(columns).collect()), key=repr)


def turns_of(convs, odd="x"):
    return [(c, k, role, text, odd, odd, odd, odd) for c, turns in convs.items() for k, (role, text) in enumerate(turns)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_tries(spark, seed):
    draw = random.Random(seed)
    convs = {}
    for c in draw.sample(range(-40, 5000), 60):
        convs[c] = [(draw.choice("ua"), draw.choice(["", "x", "yy", "é😀"])) for _ in range(draw.randint(1, 6))]
    convs[7000], convs[7001] = [("u", "x")] * 70, [("u", "x")] * 60 + [("u", "y")] * 9  # long shared and unshared stretches
    df = spark.createDataFrame(turns_of(convs), SCHEMA).repartition(7)
    assert trie_rows(prefix_trie(turn_keys(df))) == brute_force(convs)


def test_rebuilt_conversations(spark):
    draw = random.Random(4)
    own = {c: [("u", draw.choice("xy")) for _ in range(draw.randint(1, 7))] for c in [*range(0, 230, 3), 300, 512, 513, -7, -100]}
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = int(c / 100) * 100  # towards zero, as SQL's remainder has it
        convs[c] = own.get(base, [])[:h] + turns[h:]
    assert any(not turns for turns in convs.values())
    from pyspark.sql import functions as F

    conv = F.col("conv_id")
    keys = turn_keys(spark.createDataFrame(turns_of(own), SCHEMA))
    found = prefix_trie(rebuilt(keys, F.crc32(conv.cast("string").cast("binary")) % 6, 5, conv - conv % 100))
    assert trie_rows(found) == brute_force(convs)


def test_odd_conversations(spark):
    rows = [
        (1, None, None, "first"),
        (1, 0, "u", None),
        (1, 0, "u", None),  # a repeated row is a turn like any other
        (2, 5, "", "first"),
        (2, 6, "u", ""),
        (None, 0, "u", "nobody's"),
        (3, 1, "u", "long " * 50_000),
        (4, 9, "u", "long " * 50_000),
        (5, 1, "1", ":u"),
        (6, 1, "1:", "u"),
    ]
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)
    convs = {
        1: [("", "first"), ("u", ""), ("u", "")],
        2: [("", "first"), ("u", "")],
        3: [("u", "long " * 50_000)],
        4: [("u", "long " * 50_000)],
        5: [("1", ":u")],
        6: [("1:", "u")],
    }
    assert trie_rows(prefix_trie(turn_keys(df))) == brute_force(convs)


def test_equal_turn_numbers_have_one_order(spark):
    rows = [(c, 0, "u", t, "x", "x", "x", "x") for c in (1, 2) for t in ("a", "b", "c")]
    for order in (rows, rows[::-1]):
        found = trie_rows(prefix_trie(turn_keys(spark.createDataFrame(order, SCHEMA).repartition(3))))
        assert len(found) == 4 and {r[3] for r in found} == {2}


def test_no_conversations(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert prefix_trie(turn_keys(df)).count() == 0


def test_a_group_of_equal_conversations(spark):
    """Identifiers of conversations that end at one node span several ranges."""
    convs = {c: [("u", "same")] for c in range(0, 6000)} | {9000: [("u", "same"), ("a", "more")]}
    assert trie_rows(prefix_trie(turn_keys(spark.createDataFrame(turns_of(convs), SCHEMA)))) == brute_force(convs)
