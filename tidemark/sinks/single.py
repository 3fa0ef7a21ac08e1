"""One CSV file, written by many tasks."""

from __future__ import annotations

import csv
import io
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import fresh_path
from .files import write_csv

_PIECE = 8 << 20


def write_one_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> str:
    """Write the rows to the single file ``path`` (with ``.csv`` if it lacks that), with one header. Returns its path.

    Rows keep their order: those of a sorted table are sorted in the file. Tasks write parts
    in parallel first, without headers; the sizes of the parts before it give each part its
    place, and they are put together in the order of the partitions, under another name that takes
    the file's place at the end. Where the file system can concatenate files, it does so without
    moving bytes; on local and mounted ones tasks copy each part to its place, and one that
    is run again writes the same bytes there. Others cannot do this, and fail. Cells are written
    as by ``write_csv``.
    """
    if not path:
        raise ValueError("no path was given")
    spark, path = df.sparkSession, path if path.endswith(".csv") else f"{path}.csv"
    parts = write_csv(df, fresh_path(spark, "one-csv"), sep=sep, header=False)
    title = io.StringIO()
    if header:
        csv.writer(title, delimiter=sep, lineterminator="\n").writerow(df.columns)
    scratch = f"{path.rpartition('/')[0]}/.{path.rpartition('/')[2]}.{os.path.basename(parts)}"
    if _is_local(spark, path):
        _copy(_places(spark, parts, len(title.getvalue().encode())), title.getvalue().encode(), _local(scratch))
        os.replace(_local(scratch), _local(path))
    else:
        _concatenate(spark, parts, title.getvalue().encode(), scratch, path)
    return path


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _is_local(spark: SparkSession, path: str) -> bool:
    return _hadoop(spark, path)[0].getScheme() == "file"


def _local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def _places(spark: SparkSession, parts: str, start: int) -> DataFrame:
    """``path, length, offset``: where each part, in the order of the partitions, lies in the whole file."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(parts).select("path", "length")
    # One row for each part.
    before = F.sum("length").over(Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1))
    return listed.withColumn("offset", F.coalesce(before, F.lit(0)) + start)


def _copy(places: DataFrame, title: bytes, target: str) -> None:
    rows = places.where("length > 0")
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    with open(target, "wb") as out:
        out.write(title)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open(_local(row["path"]), "rb") as part, open(target, "r+b") as out:
                    out.seek(row["offset"])
                    left = row["length"]
                    while left and (piece := part.read(min(_PIECE, left))):
                        out.write(piece)
                        left -= len(piece)
                if left:
                    raise OSError(f"{row['path']} is shorter than it was")
            yield pa.RecordBatch.from_pydict({"length": batch.column("length")})

    # One task for each part: rows are dealt in turn.
    tasks = rows.repartition(max(1, rows.count()))
    written = tasks.mapInArrow(run, "length long").agg(F.sum("length")).first()[0] or 0
    if os.path.getsize(target) != len(title) + written:
        raise OSError(f"{target} has {os.path.getsize(target)} bytes, not {len(title) + written}")


def _concatenate(spark: SparkSession, parts: str, title: bytes, scratch: str, path: str) -> None:
    """By the file system: only names of parts, in order, come to the driver."""
    system, target = _hadoop(spark, scratch)
    with_title = system.create(target, True)
    with_title.write(title)
    with_title.close()
    names = [r["path"] for r in _places(spark, parts, 0).where("length > 0").orderBy("path").collect()]
    if names:
        array = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(names))
        for k, name in enumerate(names):
            array[k] = spark._jvm.org.apache.hadoop.fs.Path(name)
        system.concat(target, array)
    final = spark._jvm.org.apache.hadoop.fs.Path(path)
    system.delete(final, False)
    if not system.rename(target, final):
        raise OSError(f"{scratch} could not take the name {path}")
