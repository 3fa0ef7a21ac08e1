"""Token files: flat unsigned integers, 64-bit offsets of documents, memory-mapped reading.

A folder holds, for every part, ``NAME.ids`` (token ids one after the other, 16 bits each if
the vocabulary fits, else 32), ``NAME.offsets`` (64-bit: where each document begins among
all tokens of the folder, and at last where the part ends) and ``NAME.docs`` (64-bit document
identifiers), all little-endian; and the Parquet table ``parts`` with a row for each part:
its name, numbers of documents and tokens, and the tokens of all parts before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import byte_bpe
from tidemark.llm.shared import filesystem, ship

#: Fixed value: a document without identifier.
NO_ID = np.iinfo(np.int64).min
#: Tokens read back at a time.
_TOKENS = 1 << 20


def write_token_files(
    df: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode every text, end it with ``end_id``, and write it to ``path``; returns the table of parts.

    Documents are written in ascending order of their integer identifiers, null ones first;
    ties in the order of their texts. A null text counts as empty and is its end id alone.
    An empty table makes no parts. ``path`` must be one that every executor can reach. A
    task writes under a name of its own and the table of parts is written last, so what a
    lost task leaves behind belongs to no part.
    """
    spark = df.sparkSession
    ship(spark)
    id_type = np.dtype("<u2") if max(byte_bpe(tokenizer).size, end_id + 1) <= 1 << 16 else np.dtype("<u4")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, (store, folder) = byte_bpe(tokenizer), filesystem(path)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        docs = tokens = 0
        store.create_dir(folder, recursive=True)
        with (
            store.open_output_stream(f"{folder}/{name}.ids") as ids_out,
            store.open_output_stream(f"{folder}/{name}.lengths") as lengths_out,
            store.open_output_stream(f"{folder}/{name}.docs") as docs_out,
        ):
            for batch in batches:
                docs_out.write(batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                for ids, lengths in encoder.encode_column(batch.column(1)):
                    # An end behind each document.
                    ids_out.write(np.insert(ids.astype(id_type), np.cumsum(lengths), end_id).tobytes())
                    lengths_out.write((lengths + 1).astype("<i8").tobytes())
                    docs, tokens = docs + len(lengths), tokens + len(ids) + len(lengths)
        if docs:
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "name": [name], "docs": [docs], "tokens": [tokens], "id_bytes": [id_type.itemsize]}
            )

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = filesystem(path)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{folder}/{row['name']}.lengths") as file:
                    lengths = np.frombuffer(file.read(), "<i8")
                with store.open_output_stream(f"{folder}/{row['name']}.offsets") as out:
                    out.write((row["tokens_before"] + np.concatenate([[0], np.cumsum(lengths)])).astype("<i8").tobytes())
            yield batch

    in_order = [F.col("id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.repartitionByRange(*in_order[:2]).sortWithinPartitions(*in_order)
    schema = "part long, name string, docs long, tokens long, id_bytes long"
    rows.mapInArrow(write, schema).write.parquet(f"{path}/written")
    # Prefix sums over one row per part.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = spark.read.schema(schema).parquet(f"{path}/written")
    parts = parts.withColumn("tokens_before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    parts.mapInArrow(offsets, f"{schema}, tokens_before long").write.parquet(f"{path}/parts")
    return spark.read.schema(f"{schema}, tokens_before long").parquet(f"{path}/parts")


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """The documents of a folder: ``id_col, start, n_tokens, ids``.

    ``start`` counts the tokens before the document, ``ids`` are little-endian unsigned
    32-bit integers. A part on a local or mounted path is memory-mapped; elsewhere the
    ranges needed are read.
    """
    ship(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = filesystem(path)
        local = store.type_name == "local"
        for batch in batches:
            for row in batch.to_pylist():
                stem, id_type = f"{folder}/{row['name']}", np.dtype(f"<u{row['id_bytes']}")

                def values(kind, dtype, begin, end, stem=stem):
                    if begin == end:
                        return np.empty(0, dtype)
                    if local:
                        return np.memmap(f"{stem}.{kind}", dtype, "r", begin * dtype.itemsize, (end - begin,))
                    with store.open_input_file(f"{stem}.{kind}") as file:
                        return np.frombuffer(file.read_at((end - begin) * dtype.itemsize, begin * dtype.itemsize), dtype)

                begins = values("offsets", np.dtype("<i8"), 0, row["docs"] + 1)
                names = values("docs", np.dtype("<i8"), 0, row["docs"])
                at = 0
                while at < row["docs"]:
                    end = max(at + 1, int(np.searchsorted(begins, begins[at] + _TOKENS, side="right")) - 1)
                    end = min(end, row["docs"])
                    cuts = (begins[at : end + 1] - begins[0]).tolist()
                    ids = values("ids", id_type, cuts[0], cuts[-1]).astype("<u4")
                    yield pa.RecordBatch.from_pydict(
                        {
                            id_col: pa.array(names[at:end], mask=names[at:end] == NO_ID),
                            "start": pa.array(np.asarray(begins[at:end])),
                            "n_tokens": pa.array(np.diff(begins[at : end + 1])),
                            "ids": pa.array([ids[a - cuts[0] : b - cuts[0]].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                        }
                    )
                    at = end

    parts = spark.read.parquet(f"{path}/parts")
    # One task for each part: rows are dealt in turn.
    parts = parts.repartition(max(1, parts.count()))
    return parts.mapInArrow(read, f"`{id_col}` long, start long, n_tokens long, ids binary")
