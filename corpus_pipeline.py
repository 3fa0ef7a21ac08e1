"""The corpus pipeline: documents to packed training sequences, in five stages.

Toxic documents go, of equal texts one stays, of near duplicates one stays, sources are
mixed to target weights, and what is left is packed. Each stage's rows are written as Parquet
and read again as the next one's input.

A null text counts as empty in every stage, and is kept by those that filter but where it is
a copy of an empty one; texts of any length are taken whole. Of equal texts with equal
identifiers one row stays; a row without identifier is never a near duplicate. Null sources
are a source of their own. Further columns go along, whatever their names. An empty table gives
an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.exact_dedup import drop_copies
from tidemark.llm.minhash import drop_near_duplicates
from tidemark.llm.mixing import in_reading_order, mix
from tidemark.llm.packing import pack
from tidemark.llm.queries import MIX, classifier, digest_pieces, tokenizer_file
from tidemark.llm.shared import keep
from tidemark.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, does not call toxic."""
    return drop_toxic(docs, classifier(spark, docs, sf_dir))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one of the smallest identifier."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 and more the one of the smallest identifier."""
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once and no source more than twice, in the order of reading."""
    prefix = "mix_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    return in_reading_order(mix(docs, prefix=prefix, **MIX), docs.columns, prefix=prefix)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return digest_pieces(pack(docs, tokenizer_file("byte_bpe_50k.json"), size=2048, end_id=1))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL expresses neither the classifier nor the tokenizer; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
