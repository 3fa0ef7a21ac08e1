"""What the operators share: code for the executors, kept tables, files in the shared folder."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

import tidemark
from tidemark.session import fresh_path

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this library's source to the executors, once per application.

    Their Python workers import the functions by name, so that what a worker has cached
    for one task is there for the next.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(tidemark.__file__))
    archive = os.path.join(tempfile.mkdtemp(), "tidemark_source.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and losing
    an executor repeats nothing that came before."""
    spark = df.sparkSession
    path = fresh_path(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let_go() -> None:
    """Give memory that is no longer used back to the system, at the end of a task: Python workers outlive
    their tasks, and what their allocators hold is missing to the executor's other work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def dealt_anew(grouped: DataFrame) -> DataFrame:
    """``grouped``, not as its grouping dealt it: a join on the same key then shuffles both
    sides itself, and adaptive execution can split a key that is hot on the other side."""
    return grouped.hint("rebalance")


def packed_texts(rows: DataFrame) -> DataFrame:
    """``id, text`` as ``id, packed``: texts compressed with zstd for a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [compressor.compress(t.encode()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"id": batch.column(0), "packed": pa.array(packed, pa.binary())})
        let_go()

    return rows.mapInArrow(run, "id long, packed binary")


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    if "://" in uri or uri.startswith("file:"):
        if uri.startswith("file:") and not uri.startswith("file://"):
            uri = "file://" + uri.removeprefix("file:")
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), os.path.abspath(uri)
