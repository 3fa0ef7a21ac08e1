import sys
import zlib

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F
from tidemark.llm.exact_dedup import normalise
from tidemark.llm.minhash import shingles
from tidemark.llm.queries import QUERIES, tokenizer_file


def test_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in QUERIES} and "pipeline" in names
    assert set(QUERIES) <= names


def test_stages(spark, sf, tmp_path):
    """Each stage on what its predecessor kept, against a brute-force version."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name.replace(" ", "_"))
        stage(spark, kept[-1], sf).write.parquet(path)
        kept.append(spark.read.parquet(path))
    assert all(k.columns == columns for k in kept[:-1])
    _, clean, unique, distinct, mixed, packed = kept

    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = labels.join(docs, "doc_id").join(clean.select("doc_id", F.lit(True).alias("in")), "doc_id", "left")
    right = judged.select((F.col("in").isNull() == (F.col("toxic") == 1)).cast("double").alias("r")).agg(F.mean("r")).first()[0]
    assert right > 0.9

    expected = {r.d for r in clean.groupBy(normalise(F.col("text"))).agg(F.min("doc_id").alias("d")).collect()}
    assert sorted(r.doc_id for r in unique.collect()) == sorted(expected)

    sets = {r.doc_id: set(shingles(r.text).tolist()) for r in unique.collect()}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if b < a and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert sorted(r.doc_id for r in distinct.collect()) == sorted(d for d in root if find(d) == d)

    times = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert set(times) == {r.doc_id for r in distinct.collect()} and set(times.values()) <= {1, 2}

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    ids = {r.doc_id: tokenizer.encode(r.text, add_special_tokens=False).ids + [1] for r in distinct.collect()}
    pieces = packed.collect()
    assert sum(r.length for r in pieces) == sum(len(ids[d]) * n for d, n in times.items())
    for r in pieces:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
    assert len(corpus_pipeline.STAGES) == 5 and "pyspark" in sys.modules


def test_stages_on_odd_tables(spark, sf, odd_docs, no_docs):
    """Nulls, empty and long texts, repeated rows, an empty table, and columns named as those that stages add."""
    names = ("mix_epoch", "mix_block", "mix_position", "row", "id", "text_sha256", "dropped_id", "hash", "__row")
    odd = odd_docs.select("doc_id", "text", "source", *[F.lit(n).alias(n) for n in names])
    stages = dict(corpus_pipeline.STAGES)
    for docs in (odd, odd.limit(0)):
        for name in ("toxicity", "exact dedup", "near dedup", "mixing"):
            found = stages[name](spark, docs, sf)
            assert found.columns == odd.columns, name
            kept = found.collect()
            # Every row that is left is one of the table, with its other columns as they were.
            given = {(r.doc_id, r.text, r.source) for r in docs.collect()}
            assert {(r.doc_id, r.text, r.source) for r in kept} <= given, name
            assert all(r[n] == n for r in kept for n in names), name
        lengths = {}
        for r in stages["packing"](spark, docs, sf).collect():
            lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
        assert set(lengths) == {r.doc_id for r in docs.collect()}
    exact = {(r.doc_id, r.text) for r in stages["exact dedup"](spark, odd, sf).collect()}
    assert {d for d, _ in exact if d in (3, 5, 7, 8, 9, 11)} == {3, 7, 8}
    near = [r.doc_id for r in stages["near dedup"](spark, odd, sf).collect()]
    assert 20 in near and 21 not in near and 22 not in near and {7, 8, 9} <= set(near)
    mixed = [r.doc_id for r in stages["mixing"](spark, odd, sf).collect()]
    assert set(mixed) == {r.doc_id for r in odd.collect()}
