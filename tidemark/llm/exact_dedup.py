"""Exact duplicates by a content sort.

Sampled splitters deal the normalised texts into ranges, every range is sorted on disk if
need be, equal texts are then neighbours and whole texts are compared. The splitters are
the first characters, the digest and the identifier, so that the sample a driver holds is
small whatever the texts are, and a text with many copies is spread over many ranges; the
groups that reach over the edge of a range are joined afterwards, by one row per range.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.shared import keep, ship

#: Characters of a text that take part in the splitters.
PREFIX = 64


def normalise(text: Column) -> Column:
    """Every run of ASCII white space as one space; null as empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the runs of equal neighbours; keep the texts at both ends of the range."""
    part, run, last, waiting = TaskContext.get().partitionId(), -1, None, None

    def finished(batch, numbers, first, head, tail):
        texts = batch.column("norm")
        ends = {}
        for name, at in (("head", 0 if head else None), ("tail", batch.num_rows - 1 if tail else None)):
            mask = pa.array([k == at for k in range(batch.num_rows)]) if at is not None else pa.scalar(False)
            ends[name] = pc.if_else(mask, texts, pa.scalar(None, texts.type)) if at is not None else pa.nulls(batch.num_rows, texts.type)
        kept = {n: batch.column(n) for n in batch.schema.names if n not in ("prefix", "norm")}
        kept |= {"part": pa.array([part] * batch.num_rows, pa.int64()), "run": numbers, "first": first} | ends
        return pa.RecordBatch.from_pydict(kept)

    head = True
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column("norm")
        same_as_last = last is not None and texts[0].as_py() == last
        inner = pc.not_equal(texts.slice(1), texts.slice(0, batch.num_rows - 1))
        first = pa.concat_arrays([pa.array([not same_as_last]), inner])
        numbers = pc.add(pc.cumulative_sum(pc.cast(first, pa.int64())), pa.scalar(run, pa.int64()))
        if waiting:
            yield finished(*waiting, head, False)
            head = False
        waiting, run, last = (batch, numbers, first), numbers[-1].as_py(), texts[batch.num_rows - 1].as_py()
    if waiting:
        yield finished(*waiting, head, True)


def _sorted_runs(df: DataFrame, id_col: str, text_col: str, whole_rows: bool) -> DataFrame:
    """The rows in content order with the run they are in, written to the shared folder."""
    ship(df.sparkSession)
    norm = normalise(F.col(text_col))
    rows = df.select(
        F.col(id_col).alias("id"),
        norm.alias("norm"),
        *([F.struct("*").alias("row")] if whole_rows else []),
    ).withColumns({"prefix": F.substring("norm", 1, PREFIX), "sha": F.sha2("norm", 256)})
    order = [F.col("prefix"), F.col("sha"), F.col("norm"), F.col("id").asc_nulls_last()]
    rows = rows.repartitionByRange("prefix", "sha", F.col("id").asc_nulls_last()).sortWithinPartitions(*order)
    fields = [f for f in rows.schema.fields if f.name not in ("prefix", "norm")]
    schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in fields]
        + [T.StructField("part", T.LongType()), T.StructField("run", T.LongType()), T.StructField("first", T.BooleanType())]
        + [T.StructField("head", T.StringType()), T.StructField("tail", T.StringType())]
    )
    return keep(rows.mapInArrow(_runs, schema), "content-sort")


def _ranges(runs: DataFrame) -> DataFrame:
    """One row per range: its last run, whether its first run goes on from the range
    before, and if so where that run began."""
    ends = runs.where("head is not null or tail is not null")
    ends = ends.groupBy("part").agg(F.max("head").alias("head"), F.max("tail").alias("tail"), F.max("run").alias("last_run"))
    by_part = Window.orderBy("part")
    # Numbers only go through this one window: a row for each range.
    ranked = ends.select("part", "last_run", F.lag("part").over(by_part).alias("before"))
    texts = ends.select("part", "head", "tail")
    before = texts.select(F.col("part").alias("before"), F.col("tail").alias("tail_before"))
    joined = ranked.join(before, "before", "left").join(texts.select("part", "head"), "part")
    goes_on = joined.select("part", "last_run", F.coalesce(F.col("head") == F.col("tail_before"), F.lit(False)).alias("goes_on"))
    began = F.when(~F.col("goes_on") | (F.col("last_run") > 0), F.struct(F.col("part").alias("p"), F.col("last_run").alias("r")))
    seen = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return goes_on.withColumn("began", F.last(began, ignorenulls=True).over(seen))


def mark_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's group of equal texts: ``id_col, keep_id, group_size, kept, text_sha256``.

    Texts are equal if they are after ``normalise``; a null text counts as empty, so null,
    empty and absent texts are one group. Of a group the row with the smallest identifier
    is kept, a null identifier coming last; of rows equal in text and identifier exactly
    one is kept. Other columns of ``df``, whatever their names, play no part. An empty
    table gives an empty result.
    """
    table = _sorted_runs(df, id_col, text_col, whole_rows=False)
    runs = table.groupBy("part", "run").agg(F.min("id").alias("run_keep"), F.count(F.lit(1)).alias("run_size"))
    ranges = keep(_ranges(table), "content-ranges")
    # Runs that reach over an edge: two for each range at most, so this side is small.
    over = ranges.where("goes_on").select("part", F.lit(0).cast("long").alias("run"), "began")
    owners = over.select(F.col("began.p").alias("part"), F.col("began.r").alias("run"), "began").distinct()
    linked = F.broadcast(over.unionByName(owners))
    joined = runs.join(linked, ["part", "run"])
    groups = joined.groupBy("began").agg(F.min("run_keep").alias("all_keep"), F.sum("run_size").alias("all_size"))
    spanning = linked.join(F.broadcast(groups), "began").join(
        F.broadcast(over.select("part", "run", F.lit(True).alias("goes_on"))), ["part", "run"], "left"
    )
    runs = runs.join(F.broadcast(spanning.drop("began")), ["part", "run"], "left")
    runs = runs.select(
        "part",
        "run",
        F.when(F.col("all_size").isNull(), F.col("run_keep")).otherwise(F.col("all_keep")).alias("keep_id"),
        F.coalesce("all_size", "run_size").alias("group_size"),
        F.coalesce("goes_on", F.lit(False)).alias("goes_on"),
    )
    return table.join(runs, ["part", "run"]).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("first") & ~F.col("goes_on")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that ``mark_copies`` keeps, with all their columns."""
    table = _sorted_runs(df, id_col, text_col, whole_rows=True)
    later = _ranges(table).where("goes_on").select("part", F.lit(0).cast("long").alias("run"))
    return table.where("first").join(F.broadcast(later), ["part", "run"], "left_anti").select("row.*")
