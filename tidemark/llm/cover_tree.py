"""Exact top-k search by inner product, with two cover trees.

Vectors are dealt to cells around pivots and into blocks of bounded size, and a cover tree
is built of every block; queries are gathered in groups for the cells that can still hold
a hit, with a cover tree of their own. A search walks both trees at once and drops a pair
of nodes when the inner product cannot, by the covering radii of both, reach the worst k-th
score in the query node. A first search of one block near each query sets that score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import keep, ship
from tidemark.session import BROADCAST_ROWS, has_at_most

#: Vectors of a block, queries of a group, vectors of a leaf, children of a node.
BLOCK, GROUP, LEAF, FAN = 4096, 512, 48, 32
#: Pivots at most, and vectors that they are chosen from.
PIVOTS, PIVOT_SAMPLE = 256, 2048
_LONG = np.iinfo(np.int64)


def quantise(vectors: DataFrame, id_col: str, vector_col: str, scale: int = 1024) -> DataFrame:
    """``id, dim, vector``: floor(scale * x) of every component as little-endian 64-bit integers.

    Rows without identifier, null vectors and those with null or non-finite components are
    left out. Components beyond 64 bits are set to the nearest end of that range.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, data = [], [], []
            for one, vector in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not vector.is_valid or vector.values.null_count:
                    continue
                x = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all():
                    continue
                with np.errstate(over="ignore"):
                    whole = np.floor(scale * x)
                inside = np.abs(whole) < 2.0**63
                fixed = np.where(inside, whole, 0).astype("<i8")
                fixed[~inside] = np.where(whole[~inside] > 0, _LONG.max, _LONG.min)
                ids.append(one)
                dims.append(len(x))
                data.append(fixed.tobytes())
            yield pa.RecordBatch.from_pydict(
                {"id": pa.array(ids, pa.int64()), "dim": pa.array(dims, pa.int32()), "vector": pa.array(data, pa.binary())}
            )

    rows = vectors.selectExpr(f"cast(`{id_col}` as long) id", f"`{vector_col}` vector").where("id is not null")
    return rows.mapInArrow(run, "id long, dim int, vector binary")


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; beyond 64 bits the nearest end of that range."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = a.shape[1] * max(int(a.max()), -int(a.min())) * max(int(b.max()), -int(b.min()))
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, int(_LONG.min), int(_LONG.max)).astype(np.int64)


@dataclass
class Node:
    """A ball around a vector that holds the rows ``begin`` to ``end`` of its tree."""

    centre: np.ndarray
    radius: float
    norm: float
    begin: int
    end: int
    children: list[Node]


class CoverTree:
    """Integer vectors in tree order: ``ids`` and ``rows``, and the ``root`` node if there are any."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self._points = rows.astype(np.float64)
        order: list[np.ndarray] = []
        self.root = self._node(np.arange(len(ids)), order, 0) if len(ids) else None
        at = np.concatenate(order) if order else np.arange(0)
        self.ids, self.rows = ids[at], rows[at]
        del self._points

    def _node(self, members: np.ndarray, order: list[np.ndarray], begin: int) -> Node:
        points = self._points[members]
        near = np.linalg.norm(points - points.mean(axis=0), axis=1).argmin()
        centre = points[near]
        far = np.linalg.norm(points - centre, axis=1)
        node = Node(centre, float(far.max()), float(np.linalg.norm(centre)), begin, begin + len(members), [])
        if len(members) <= LEAF or node.radius == 0:
            order.append(members)
            return node
        # A net of centres that lie more than half the radius apart, as far as the fan goes;
        # every vector goes to the nearest.
        nearest, closest, child = np.zeros(len(members), np.int64), far.copy(), 1
        while child < FAN and closest.max() > node.radius / 2:
            other = np.linalg.norm(points - points[closest.argmax()], axis=1)
            nearest[other < closest] = child
            closest = np.minimum(closest, other)
            child += 1
        if child == 1:
            order.append(members)
            return node
        for k in range(child):
            if len(part := members[nearest == k]):
                node.children.append(self._node(part, order, begin))
                begin += len(part)
        return node


class Search:
    """The best ``k`` rows of data trees for every row of a query tree."""

    def __init__(self, queries: CoverTree, k: int, least: np.ndarray):
        self.queries, self.k = queries, k
        # A query's k-th best score so far, from below; negative infinity while it has fewer.
        self.worst = least.astype(np.float64)
        self.found: list[list[tuple[int, int]]] = [[] for _ in queries.ids]

    def run(self, data: CoverTree) -> None:
        if self.queries.root and data.root:
            self._pair(self.queries.root, data.root, data)

    def _bounds(self, pairs: list[tuple[Node, Node]]) -> np.ndarray:
        q = np.array([a.centre for a, _ in pairs])
        p = np.array([b.centre for _, b in pairs])
        rq, rp = np.array([a.radius for a, _ in pairs]), np.array([b.radius for _, b in pairs])
        nq, np_ = np.array([a.norm for a, _ in pairs]), np.array([b.norm for _, b in pairs])
        most = (q * p).sum(axis=1) + rq * np_ + rp * nq + rq * rp
        # Room for rounding.
        return most + 1e-9 * (nq + rq) * (np_ + rp) + 1e-6

    def _pair(self, a: Node, b: Node, data: CoverTree) -> None:
        if not a.children and not b.children:
            self._leaves(a, b, data)
            return
        if a.children and (not b.children or a.radius >= b.radius):
            pairs = [(c, b) for c in a.children]
        else:
            pairs = [(a, c) for c in b.children]
        bounds = self._bounds(pairs)
        for at in np.argsort(-bounds):
            if bounds[at] >= self.worst[pairs[at][0].begin : pairs[at][0].end].min():
                self._pair(*pairs[at], data)

    def _leaves(self, a: Node, b: Node, data: CoverTree) -> None:
        scores = products(self.queries.rows[a.begin : a.end], data.rows[b.begin : b.end])
        ids = data.ids[b.begin : b.end]
        for row in np.flatnonzero(scores.max(axis=1) >= self.worst[a.begin : a.end]):
            query = a.begin + row
            good = np.flatnonzero((scores[row] >= self.worst[query]) & (ids != self.queries.ids[query]))
            if len(good):
                good = good[np.lexsort((ids[good], -scores[row][good].astype(object)))][: self.k]
                both = self.found[query] + [(-int(scores[row][x]), int(ids[x])) for x in good]
                self.found[query] = both = sorted(both)[: self.k]
                if len(both) == self.k:
                    self.worst[query] = max(self.worst[query], float(-both[-1][0]))


def _packed(frame: pd.DataFrame) -> CoverTree:
    dim = int(frame["dim"].iat[0])
    rows = np.frombuffer(b"".join(frame["vector"]), "<i8").reshape(len(frame), dim)
    return CoverTree(frame["id"].to_numpy(np.int64), rows)


def _pivots(vectors: DataFrame, blocks: int) -> dict[int, np.ndarray]:
    """Pivots for each dimension, far from each other, from a bounded sample on the driver."""
    chosen = vectors.orderBy(F.xxhash64("id"), "id").limit(PIVOT_SAMPLE).toPandas()
    found = {}
    for dim, frame in chosen.groupby("dim"):
        points = np.frombuffer(b"".join(frame["vector"]), "<i8").reshape(len(frame), dim).astype(np.float64)
        picked, closest = [0], np.linalg.norm(points - points[0], axis=1)
        while len(picked) < min(PIVOTS, blocks) and closest.max() > 0:
            picked.append(int(closest.argmax()))
            closest = np.minimum(closest, np.linalg.norm(points - points[picked[-1]], axis=1))
        found[int(dim)] = points[picked]
    return found


def _in_cells(vectors: DataFrame, pivots) -> DataFrame:
    """``id, dim, vector`` with the nearest pivot's ``cell`` and the distance ``far`` to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, far = [], []
            for dim, vector in zip(batch.column("dim").to_pylist(), batch.column("vector").to_pylist(), strict=True):
                x = np.frombuffer(vector, "<i8").astype(np.float64)
                there = pivots.value.get(dim, np.zeros((1, dim)))
                distance = np.linalg.norm(there - x, axis=1)
                cells.append(int(distance.argmin()))
                far.append(float(distance.min()))
            yield pa.RecordBatch.from_pydict(
                {n: batch.column(n) for n in ("id", "dim", "vector")}
                | {"cell": pa.array(cells, pa.int32()), "far": pa.array(far, pa.float64())}
            )

    return vectors.mapInArrow(run, "id long, dim int, vector binary, cell int, far double")


def _searched(queries: DataFrame, blocks: DataFrame, on: list[str], k: int) -> DataFrame:
    """``query_id, vec_id, score``: hits of every query in the blocks that share ``on``.

    ``queries`` are ``id, dim, vector, least`` and ``on``; a group of them goes to every block
    of its kind, tree against tree.
    """
    sizes = queries.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    sized = queries.join(sizes, on).withColumn("part", F.pmod(F.xxhash64("id", F.lit(3)), F.ceil(F.col("n") / GROUP)))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        first = frame.iloc[0]
        return pd.DataFrame(
            {
                **{c: [first[c]] for c in on},
                "query_ids": [frame["id"].to_numpy("<i8").tobytes()],
                "query_rows": [b"".join(frame["vector"])],
                "least": [frame["least"].to_numpy("<f8").tobytes()],
            }
        )

    kinds = ", ".join(f"`{c}` {t}" for c, t in queries.select(*on).dtypes)
    groups = sized.groupBy(*on, "part").applyInPandas(pack, f"{kinds}, query_ids binary, query_rows binary, least binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits: list[tuple[int, int, int]] = []
            for row in batch.to_pylist():
                ids = np.frombuffer(row["query_ids"], "<i8")
                rows = np.frombuffer(row["query_rows"], "<i8").reshape(len(ids), row["dim"])
                least = dict(zip(ids.tolist(), np.frombuffer(row["least"], "<f8").tolist(), strict=True))
                tree = CoverTree(ids, rows)
                search = Search(tree, k, np.array([least[x] for x in tree.ids.tolist()]))
                own = np.frombuffer(row["ids"], "<i8")
                search.run(CoverTree(own, np.frombuffer(row["rows"], "<i8").reshape(len(own), row["dim"])))
                for query, found in zip(tree.ids.tolist(), search.found, strict=True):
                    hits += [(query, one, -score) for score, one in found]
            columns = list(zip(*hits, strict=True)) or [(), (), ()]
            names = ("query_id", "vec_id", "score")
            yield pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

    pairs = groups.join(blocks, on).select("dim", "query_ids", "query_rows", "least", "ids", "rows")
    return pairs.mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024
) -> DataFrame:
    """The ``k`` highest integer inner products of every query with the other rows:
    ``query_id, rank, vec_id, score``; ties go to the smaller identifier.

    Queries are the rows where ``is_query`` holds. ``quantise`` tells which rows take no
    part; vectors of different lengths are not compared; an empty vector scores 0. A query
    never finds rows of its own identifier; of rows that repeat a query's identifier, the
    one with the least vector asks. Fewer rows than ``k`` are all returned; an empty table
    gives an empty result. Scores beyond 64 bits are the nearest end of that range.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = keep(quantise(vectors, id_col, vector_col, scale), "vectors")
    asked = vectors.where(is_query).select(F.col(id_col).cast("long").alias("id")).distinct()
    total = rows.count()
    pivots = spark.sparkContext.broadcast(_pivots(rows, -(-total // BLOCK)))  # at most PIVOT_SAMPLE vectors
    placed = keep(_in_cells(rows, pivots), "vectors-in-cells")
    cells = placed.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("size"), F.max("far").alias("radius"))
    cells = cells.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).drop("size")
    cells = keep(cells, "vector-cells")
    cells = F.broadcast(cells) if has_at_most(cells, BROADCAST_ROWS) else cells

    def block(frame: pd.DataFrame) -> pd.DataFrame:
        first = frame.iloc[0]
        return pd.DataFrame(
            {
                **{c: [first[c]] for c in ("dim", "cell", "block")},
                "ids": [frame["id"].to_numpy("<i8").tobytes()],
                "rows": [b"".join(frame["vector"])],
            }
        )

    split = placed.join(cells, ["dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    blocks = split.groupBy("dim", "cell", "block").applyInPandas(block, "dim int, cell int, block int, ids binary, rows binary")
    blocks = keep(blocks, "vector-blocks")

    queries = split.join(asked, "id", "left_semi").groupBy("id").agg(F.min(F.struct("dim", "vector", "cell", "blocks")).alias("v"))
    queries = queries.select("id", "v.*", F.lit(float("-inf")).alias("least"))
    queries = keep(queries, "queries")
    near = queries.withColumn("block", F.pmod(F.xxhash64("id", F.lit(5)), "blocks").cast("int")).drop("blocks")
    first = _searched(near, blocks, ["dim", "cell", "block"], k)
    least = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").cast("double").alias("kth")).where(f"n >= {k}")
    # One block returns k hits at most for a query, so the smallest of k is the k-th.
    known = keep(queries.join(least.withColumnRenamed("query_id", "id"), "id", "left"), "queries-near")
    known = known.withColumn("least", F.coalesce("kth", "least")).select("id", "dim", "vector", "least")

    targets = known.join(cells.withColumnRenamed("cell", "target"), "dim")
    targets = _reaching(targets.select("id", "dim", "vector", "least", "target", "radius"), pivots)
    hits = _searched(targets, blocks, ["dim", "cell"], k)
    # A block's hits reach the query's first bound, so few are left to rank.
    return _ranked(hits, k)


def _reaching(targets: DataFrame, pivots) -> DataFrame:
    """The pairs of query and cell whose best inner product can reach the query's bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = []
            for row in zip(*[batch.column(n).to_pylist() for n in ("dim", "vector", "least", "target", "radius")], strict=True):
                dim, vector, least, target, radius = row
                x = np.frombuffer(vector, "<i8").astype(np.float64)
                there = pivots.value.get(dim, np.zeros((1, dim)))[target]
                norm = float(np.linalg.norm(x))
                most = float(x @ there) + norm * radius
                wanted.append(most + 1e-9 * norm * (float(np.linalg.norm(there)) + radius) + 1e-6 >= least)
            kept = batch.filter(pa.array(wanted, pa.bool_()))
            yield pa.RecordBatch.from_pydict(
                {n: kept.column(n) for n in ("id", "dim", "vector", "least")} | {"cell": kept.column("target")}
            )

    return targets.mapInArrow(run, "id long, dim int, vector binary, least double, cell int")


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
