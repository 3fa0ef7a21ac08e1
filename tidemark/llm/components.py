"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import dealt_anew, keep


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of the undirected ``edges`` ``(a, b)`` of longs.

    The component is its smallest node. Each round hooks the larger neighbours of a node,
    then the smaller ones, to its smallest neighbour; minima are taken before rows are
    shuffled, and the joins that follow can be split where a node has many edges. Rounds
    go on until nothing changes. Rows with a null, loops and repeated edges add nothing.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = keep(edges.where("a > b").distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
        large = both.where("b > a").join(dealt_anew(least), "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(dealt_anew(least), "a")
        small = small.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a > b")
        edges = keep(small.unionByName(least.withColumnRenamed("least", "b")).distinct(), "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    # Every component is now a star around its smallest node.
    centres = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)
