import hashlib
import math
import random
import tracemalloc

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tidemark.llm import toxicity
from tidemark.llm.cover_tree import products, top_k
from tidemark.llm.mixing import GRID, in_reading_order, mix, plan_mix, word_count
from tidemark.llm.mixing_sql import mixing_sql
from tidemark.llm.toxicity import drop_toxic, features, held_out, score, train


def _brute(vectors, k):
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in vectors.items()}
    out = []
    for q in vectors:
        if q % 100 == 0:
            scores = [(-sum(a * b for a, b in zip(whole[q], w)), i) for i, w in whole.items() if i != q and len(w) == len(whole[q])]
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def test_top_k(spark, rows, monkeypatch):
    import tidemark.llm.cover_tree as module

    monkeypatch.setattr(module, "BLOCK", 150)
    monkeypatch.setattr(module, "GROUP", 4)
    rng = random.Random(9)
    vectors = {i: [rng.gauss(0, 1) + (i % 5) * 3 for _ in range(6)] for i in range(0, 1200)}
    vectors |= {i: [1.0] * 6 for i in range(3000, 3400)}  # equal vectors, more than a block
    vectors |= {5000: [0.5, 0.25], 5001: [1.0, -1.0], 5003: [2.0, 2.0], 5100: []}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    given = df.unionByName(
        spark.createDataFrame(
            [(9000, None), (9001, [None, 1.0] * 3), (9002, [math.nan] * 6), (9100, [math.inf] * 6), (None, [1.0] * 6)],
            "vec_id long, embedding array<double>",
        )
    ).withColumn("rank", F.lit("clash"))
    assert rows(top_k(given.repartition(3), F.col("vec_id") % 100 == 0, 10)) == _brute(vectors, 10)
    assert top_k(given.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_products_are_exact():
    a = np.array([[2**40, -(2**40) + 1], [3, 4]], np.int64)
    b = np.array([[2**20 + 1, 2**20], [2**62, 2**62]], np.int64)
    exact = a.astype(object) @ b.astype(object).T
    assert products(a, b).tolist() == [[max(-(2**63), min(2**63 - 1, x)) for x in r] for r in exact.tolist()]
    assert products(a[:, :1], b[:1, :1]).tolist() == (a[:, :1].astype(object) @ b[:1, :1].astype(object)).tolist()


def test_mix_by_sql(spark, sf, rows):
    """The same rows as the SQL, for limits that bend the weights more or less."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    for repeats in (1.0, 1.5, 4.0):
        options = {"max_repeats": repeats, "block_tokens": 300, "seed": 3}
        found = mix(docs, **options).select("doc_id", "source", word_count(F.col("text")).alias("n_tokens"), "epoch", "block", "position")
        assert rows(found) == sorted(con.execute(mixing_sql("documents", **options)).fetchall(), key=repr)


def test_mix_to_an_entropy(spark, rows):
    rng = random.Random(1)
    data = [(i, " ".join(["w"] * rng.randrange(1, 20)), "abcd"[min(3, int(rng.expovariate(1)))]) for i in range(600)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    target = 1.3
    sources, _ = plan_mix(df, target_entropy=target, block_tokens=100)
    found = {r.key: r for r in sources.collect()}
    total = sum(r.tokens for r in found.values())

    def entropy(a):
        powers = [(r.tokens / total) ** a for r in found.values()]
        return -sum(p / sum(powers) * math.log(p / sum(powers)) for p in powers)

    weights = [r.weight for r in found.values()]
    reached = -sum(w * math.log(w) for w in weights)
    exponent = max(k for k in range(0, GRID + 1, 16) if entropy(k / GRID) >= target) / GRID
    assert sum(weights) == pytest.approx(1) and target <= reached < target + 1e-3 and exponent > 0
    mixed = mix(df, target_entropy=target, block_tokens=100)
    read = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("n")).collect()}
    for key, r in found.items():
        assert abs(read[key[1:]] - r.budget) <= 150
    assert mixed.select("doc_id").distinct().count() == 600
    # Any stretch of the order has about the weights of the whole.
    ordered = in_reading_order(mixed, ["doc_id", "source"])
    assert ordered.columns == ["doc_id", "source"] and ordered.count() == mixed.count()
    # A target beyond all sources being alike, and one that needs no change.
    for goal, expected in ((9.0, {0.25}), (0.0, {round(r.tokens / total, 9) for r in found.values()})):
        sources, _ = plan_mix(df, target_entropy=goal, block_tokens=100)
        assert {round(r.weight, 9) for r in sources.collect()} == expected


def test_mix_of_odd_rows(spark, odd_docs, no_docs):
    mixed = mix(odd_docs, max_repeats=1.0, block_tokens=50, prefix="mix_")
    assert mixed.columns == [*odd_docs.columns, "mix_epoch", "mix_block", "mix_position"]
    assert mixed.count() == odd_docs.count()  # every row once, sources without a name too
    replaced = mix(odd_docs, max_repeats=1.0, block_tokens=50)
    assert dict(replaced.dtypes)["epoch"] == "bigint" and replaced.count() == odd_docs.count()
    assert mix(no_docs, max_repeats=2.0).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert mix(blank, max_repeats=2.0).count() == 2
    with pytest.raises(ValueError):
        mix(odd_docs)
    with pytest.raises(ValueError):
        mix(odd_docs, max_repeats=0.5)


def test_mixing_plan_is_native(spark, odd_docs):
    plan = mix(odd_docs, max_repeats=2.0, block_tokens=50)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_blocks_of_many_sources_are_numbered_by_ranges(spark, rows):
    """More blocks than one task should sort: no window over all of them, and the positions of the SQL."""
    given = [(i, " ".join(["w"] * (1 + i % 7)), f"s{i % 2500}") for i in range(5000)]
    df = spark.createDataFrame(given, "doc_id long, text string, source string")
    options = {"max_repeats": 2.0, "block_tokens": 8, "seed": 5}
    _, blocks = plan_mix(df, **options)
    plan = blocks._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and plan.count("windowspecdefinition(") == plan.count("windowspecdefinition(__part") > 0
    assert sorted(r.position for r in blocks.select("position").collect()) == list(range(blocks.count()))
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", given)
    found = mix(df, **options).select("doc_id", "source", word_count(F.col("text")).alias("n_tokens"), "epoch", "block", "position")
    assert rows(found) == sorted(con.execute(mixing_sql("documents", **options)).fetchall(), key=repr)


def test_features():
    assert features(None).tolist() == features("").tolist()
    assert features("ABC abc").tolist() == features("abc ABC").tolist()
    assert len(features("x" * 50_000)) <= 9
    assert set(features("idiot")) <= set(features("you idiot !"))


def test_toxicity(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = docs.join(labels, "doc_id").select("doc_id", "text", F.col("toxic").alias("label"), held_out("doc_id").alias("held"))
    model = train(rows.where("not held"), key_col="doc_id")
    scored = score(rows, model).select("held", "label", "score").collect()
    assert all(0 <= r.score <= 1 for r in scored)
    right = [(r.score >= 0.5) == (r.label == 1) for r in scored if r.held]
    assert len(right) > 50 and sum(right) / len(right) > 0.9
    again = train(rows.where("not held").repartition(3), key_col="doc_id")
    assert np.allclose(again.weights, model.weights) and again.constant == pytest.approx(model.constant)


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    labelled = spark.createDataFrame(
        [("you fool", 1, "a"), ("fine day", 0, "b"), (None, 0, None), ("", None, "c"), ("other", 7, "d"), ("fool again", 1, "a")] * 3,
        "text string, label int, key string",
    )
    model = train(labelled)
    found = score(odd_docs, model)
    assert found.count() == odd_docs.count() and found.where("score is null or score < 0 or score > 1").count() == 0
    texts = spark.createDataFrame([(1, "such a fool"), (2, "nice")], "doc_id long, text string")
    assert [r.doc_id for r in drop_toxic(texts, model).collect()] == [2]
    kept = drop_toxic(odd_docs, model)
    assert kept.columns == odd_docs.columns
    for few, expected in ((labelled.where("label = 1"), 1.0), (labelled.where("label = 0"), 0.0), (labelled.limit(0), 0.0)):
        (only,) = score(texts.limit(1), train(few)).collect()
        assert only.score == pytest.approx(expected, abs=1e-6)
    assert score(no_docs, model).count() == 0


def test_blocks_beyond_any_window(spark):
    """One source with more than 65,536 blocks of one token: places as one running sum gives them."""
    docs = spark.range(0, 110_000, 1, 6).selectExpr("id AS doc_id", "'w' AS text", "IF(id % 20 = 0, 'few', 'many') AS source")
    sources, placed = plan_mix(docs, max_repeats=2.0, block_tokens=1, seed=3)
    totals = {r["key"]: r for r in sources.collect()}
    hashes = docs.select("source", F.md5(F.concat_ws("|", F.lit("3"), F.col("doc_id").cast("string"))).alias("h")).collect()
    sizes: dict[tuple[str, int], int] = {}
    for r in hashes:
        key = f"={r['source']}"
        block = (key, int(r["h"][:8], 16) % totals[key]["n_blocks"])
        sizes[block] = sizes.get(block, 0) + 1
    assert sum(key == "=many" for key, _ in sizes) > 65_536
    taken = []
    for key, source in totals.items():
        for epoch in range(max(1, math.ceil(source["budget"] / source["tokens"] - 1e-9))):
            before = epoch * source["tokens"]
            blocks = [b for k, b in sizes if k == key]
            for block in sorted(blocks, key=lambda b: hashlib.md5(f"3|{epoch}|{key}|{b}".encode()).hexdigest()):
                middle = before + sizes[key, block] / 2
                before += sizes[key, block]
                if middle <= source["budget"] + 0.5:
                    taken.append((math.floor(1e9 * middle / max(source["budget"], 1.0)), key, epoch, block))
    expected = [(key, block, epoch, position) for position, (_, key, epoch, block) in enumerate(sorted(taken))]
    assert [tuple(r) for r in placed.orderBy("position").collect()] == expected


def _plain_grams(text, buckets):
    """Features by definition, in plain integers."""
    chars = [ord(c) for c in f" {(text or '').lower()} "]
    found = set()
    for n in (3, 4, 5):
        for at in range(len(chars) - n + 1):
            value = 0x811C9DC5
            for c in chars[at : at + n]:
                value = (value * 0x01000193) % 2**32 ^ ((c + 1) * 2_654_435_761) % 2**32
            found.add((((value ^ value >> 15) * 2_654_435_761) % 2**32) >> (33 - buckets.bit_length()))
    return sorted(found)


def test_scores_by_brute_force(spark):
    """The registered classifier's score, from counts to the last step, without arrays."""
    buckets, steps, penalty = 1 << 18, 80, 6e-3
    rng = random.Random(12)
    words = ["fine", "day", "you", "fool", "idiot", "weather", "nice", "stupid", "café", "moon"]
    data = []
    for key in range(24):
        toxic = key % 3 == 0
        chosen = rng.choices(words[3:5] + words[7:8] + words[:3], k=5) if toxic else rng.choices(words[:3] + words[5:7] + words[8:], k=5)
        data.append((" ".join(chosen), int(toxic), str(key)))
    model = train(spark.createDataFrame(data, "text string, label int, key string").repartition(3))
    grams = [_plain_grams(text, buckets) for text, _, _ in data]
    labels = [label for _, label, _ in data]
    for text, own in zip((t for t, _, _ in data), grams):
        assert features(text).tolist() == own
    totals = [labels.count(0), labels.count(1)]
    held = [{}, {}]
    for own, label in zip(grams, labels):
        for g in own:
            held[label][g] = held[label].get(g, 0) + 1
    ratio = {}
    for g in held[0].keys() | held[1].keys():
        other, toxic = ((held[k].get(g, 0) + 1) / (totals[k] + 2) for k in (0, 1))
        ratio[g] = math.log(toxic / (1 - toxic)) - math.log(other / (1 - other))
    weight, past, constant, past_constant = dict.fromkeys(ratio, 0.0), dict.fromkeys(ratio, 1e-12), 0.0, 1e-12
    for _ in range(steps):
        slope, whole = dict.fromkeys(ratio, 0.0), 0.0
        for own, label in zip(grams, labels):
            z = sum(weight[g] * ratio[g] for g in own) + constant
            error = 0.5 / totals[label] * (1 / (1 + math.exp(-z)) - label)
            whole += error
            for g in own:
                slope[g] += error * ratio[g]
        past_constant += whole**2
        for g in ratio:
            past[g] += slope[g] ** 2
            step = 0.1 / math.sqrt(past[g])
            moved = weight[g] - step * slope[g]
            weight[g] = math.copysign(max(abs(moved) - step * penalty, 0.0), moved)
        constant -= 0.1 * whole / math.sqrt(past_constant)
    tried = [t for t, _, _ in data] + ["", None, "you stupid moon", "unseen words"]
    expected = []
    for text in tried:
        z = sum(weight.get(g, 0.0) * ratio.get(g, 0.0) for g in _plain_grams(text, buckets)) + constant
        expected.append(1 / (1 + math.exp(-z)))
    found = score(spark.createDataFrame(list(enumerate(tried)), "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert [r.score for r in found] == pytest.approx(expected, abs=1e-9)


def test_fit_is_bounded_by_features(spark):
    """Rows with long texts are left out of the regression, not of the counts; ties of keys have one order."""
    rng = random.Random(3)
    long = " ".join("".join(rng.choices("abcdefghij", k=8)) for _ in range(4000))
    rows = [(f"you fool {k}", 1, "same") for k in range(20)] + [(f"fine day {k}", 0, "same") for k in range(20)]
    rows += [(long, 1, "same"), (long + " x", 0, "same")]
    df = spark.createDataFrame(rows, "text string, label int, key string")
    models = [train(df.repartition(n), fit_features=8000, fit_rows=12) for n in (1, 5)]
    assert np.array_equal(models[0].weights, models[1].weights) and models[0].constant == models[1].constant
    assert np.count_nonzero(models[0].weights) <= 8000
    assert np.count_nonzero(train(df, fit_features=10**6).weights) >= np.count_nonzero(models[0].weights)


def test_the_fit_needs_little_memory_beyond_its_features():
    """Six million features, in rows of different lengths; a step takes them in block by block."""
    rng = np.random.default_rng(3)
    rows = [np.flatnonzero(rng.random(1 << 18) < share).astype(np.int32) for share in np.linspace(0.01, 0.45, 100)]
    n, labels = sum(map(len, rows)), np.arange(100) % 2.0
    tracemalloc.start()
    weights, _ = toxicity._logistic(rows, labels, rng.normal(size=1 << 18), 3, 1e-4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 5_500_000 and peak < 14 * n and np.count_nonzero(weights) > 1000
