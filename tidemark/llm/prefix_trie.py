"""The prefix trie of conversations by truncation peeling.

A conversation is its turns in order; a node of depth d is a distinct sequence of d turns. From
the greatest depth upwards, conversations that end at a level are merged with the nodes that
are left from below, the last turn is stripped, and equal sequences are regrouped; a node's
totals are complete when it is met. At most levels nothing can meet: a node there has one
child, or none, and only its own members. Such levels are stripped together with the next one
at which sequences part or end, so there are as many rounds as there are such levels, however
long the longest conversation is.

A sequence is named by a 128-bit digest of the digest of the sequence before it and of its
last turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import dealt_anew, keep, ship

_ROOT = b""
_PATH = pa.struct([("key", pa.binary()), ("points", pa.int64())])
#: Turns of a batch of paths.
_TURNS = 1 << 16
#: Identifiers are joined to text in ranges of 2 ** 10, so that no group holds more of them.
_RANGE_BITS = 10


def turn_keys(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Turns without their texts: ``conv_id, part, place, tie, digest, points``.

    ``points`` counts the code points of the text. A null role or text is empty. Turns lie in the
    order of ``part``, ``place`` (null first) and ``tie``: turns of equal number lie in the order
    of the MD5 of length of role, role and text. Rows without conversation are left out.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    rows = df.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.lit(1).alias("part"),
        F.col(turn_col).cast("long").alias("place"),
        digest.alias("tie"),
        digest.alias("digest"),
        F.length(text).cast("long").alias("points"),
    )
    return rows


def rebuilt(keys: DataFrame, head: Column, most: int, base: Column) -> DataFrame:
    """Conversations that begin with the first turns of another one.

    Conversation ``conv_id`` gets the first ``head`` turns of conversation ``base`` (both Columns over
    ``conv_id``; all of them if there are fewer, none if there is no such conversation), and after
    them its own turns but the first ``head``. ``most`` bounds ``head``. A conversation without
    turns of its own left stays, as a row of part -1 without digest.
    """
    # Only so many turns of each conversation are ranked, in map tasks first.
    in_order = Window.partitionBy("conv_id").orderBy(F.col("place").asc_nulls_first(), "tie")
    numbered = keys.withColumn("number", F.row_number().over(in_order).cast("long"))
    own = numbered.where(F.col("number") > head)
    ids = keys.select("conv_id").distinct().withColumns({"base": base, "head": head})
    firsts = numbered.where(F.col("number") <= most).select(
        F.col("conv_id").alias("base"), "number", "tie", "digest", "points"
    )
    lent = firsts.join(ids.where("base is not null and head > 0"), "base").where(F.col("number") <= F.col("head"))
    columns = ["conv_id", "part", "place", "tie", "digest", "points"]
    lent = lent.select("conv_id", F.lit(0).alias("part"), F.col("number").alias("place"), "tie", "digest", "points")
    none = F.lit(None)
    marks = ids.select(
        "conv_id", F.lit(-1).alias("part"), none.cast("long").alias("place"), none.cast("binary").alias("tie"),
        none.cast("binary").alias("digest"), F.lit(0).cast("long").alias("points"),
    )
    return own.select(columns).unionByName(lent.select(columns)).unionByName(marks)


def _paths(keys: DataFrame) -> DataFrame:
    """``conv_id, path``: the names of a conversation's prefixes, with the code points so far.

    Rows come sorted, so a task holds one conversation's path (some 40 bytes a turn) and the batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, ends, names, totals = [], [0], [], []
        last, key, points = None, _ROOT, 0

        def table() -> pa.RecordBatch:
            items = pa.StructArray.from_arrays([pa.array(names, pa.binary()), pa.array(totals, pa.int64())], fields=list(_PATH))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)], ["conv_id", "path"]
            )

        for batch in batches:
            for conv, digest, n in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "digest", "points")), strict=True):
                if conv != last:
                    if last is not None:
                        ids.append(last)
                        ends.append(len(names))
                    if len(names) >= _TURNS or len(ids) >= _TURNS:
                        yield table()
                        ids, ends, names, totals = [], [0], [], []
                    last, key, points = conv, _ROOT, 0
                if digest is not None:
                    key, points = hashlib.blake2b(key + digest, digest_size=16).digest(), points + n
                    names.append(key)
                    totals.append(points)
        if last is not None:
            ids.append(last)
            ends.append(len(names))
            yield table()

    rows = keys.repartition("conv_id").sortWithinPartitions(
        "conv_id", "part", F.col("place").asc_nulls_first(), "tie"
    )
    schema = "conv_id long, path array<struct<key: binary, points: bigint>>"
    return rows.select("conv_id", "digest", "points").mapInArrow(run, schema)


def _ends(classes: DataFrame) -> DataFrame:
    """``key, ends_sha256``: a digest of the identifiers of the conversations that end at a node.

    Identifiers are put together by ranges; a node's ranges follow each other in one task,
    which holds no more than the digest's state.
    """
    ranges = classes.groupBy("key", F.shiftright("conv_id", _RANGE_BITS).alias("range")).agg(F.collect_list("conv_id").alias("ids"))
    texts = ranges.select("key", "range", F.array_join(F.sort_array("ids").cast("array<string>"), ",").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, hashlib.sha256()
        for batch in batches:
            keys, ends = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key != last:
                    if last is not None:
                        keys.append(last)
                        ends.append(state.hexdigest())
                    last, state = key, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.binary()), "ends_sha256": pa.array(ends, pa.string())})
        if last is not None:
            yield pa.RecordBatch.from_pydict(
                {"key": pa.array([last], pa.binary()), "ends_sha256": pa.array([state.hexdigest()], pa.string())}
            )

    rows = texts.repartition("key").sortWithinPartitions("key", "range").select("key", "text")
    return rows.mapInArrow(run, "key binary, ends_sha256 string")


def _key(depth: Column) -> Column:
    """The name of the prefix of so many turns."""
    return F.coalesce(F.get("path", depth - 1)["key"], F.lit(_ROOT))


def _points(depth: Column) -> Column:
    return F.coalesce(F.get("path", depth - 1)["points"], F.lit(0).cast("long"))


def _meeting_depths(classes: DataFrame) -> list[int]:
    """Depths at which sequences part, or one ends inside another; 0 besides. One number for each."""
    steps = classes.select(
        "depth", "path", F.posexplode(F.concat(F.array(F.lit(_ROOT)), F.transform("path", lambda x: x["key"]))).alias("at", "key")
    )
    steps = steps.select("key", "at", F.when(F.col("at") < F.col("depth"), F.xxhash64(F.get("path", F.col("at"))["key"])).alias("next"))
    nodes = steps.groupBy("key", "at").agg(
        F.min("next").alias("least"), F.max("next").alias("most"), F.max(F.col("next").isNull()).alias("ends")
    )
    found = nodes.where("least < most or (ends and least is not null)").select("at").distinct()
    return sorted({0} | {r.at for r in found.collect()}, reverse=True)


def prefix_trie(keys: DataFrame) -> DataFrame:
    """Every node of the trie of the conversations given as ``turn_keys``.

    Returns ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id`` (the parent's ``conv_id``; null
    for the root), ``n_convs`` (conversations that begin with the node's turns), ``n_children``,
    ``n_leaves`` (nodes without children in the subtree, the node included), ``saved_tokens`` (over the
    subtree, code points of each node's last text for every member but one) and ``ends_sha256``
    (SHA-256 of the comma-joined ascending identifiers of the conversations that end there).

    The root has no turns and every conversation as member, also those without turns (a row
    without digest names such a one). Repeated rows are turns like any others. No conversations,
    no nodes, not even the root.
    """
    spark = keys.sparkSession
    ship(spark)
    paths = keep(_paths(keys), "trie-paths").withColumn("depth", F.size("path"))
    paths = paths.withColumn("key", _key(F.col("depth")))
    ends = keep(_ends(paths.select("key", "conv_id")), "trie-ends")
    # Conversations of equal turns end at one node: they are one row from here on.
    classes = paths.groupBy("key").agg(F.first("path").alias("path"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    classes = keep(classes.withColumn("depth", F.size("path")), "trie-classes")
    depths = _meeting_depths(classes)

    def totals(rows: DataFrame, low: int) -> DataFrame:
        """Nodes with the totals of their subtrees; ``low`` is the depth of the next round."""
        own = (F.col("n_convs") - 1) * (_points(F.col("depth")) - _points(F.col("depth") - 1))
        return rows.select(
            "key", "path", "depth", F.lit(low).alias("low"), "conv_id", "n_convs", "n_children",
            F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(F.col("n_leaves")).alias("n_leaves"),
            (F.col("saved") + own).alias("saved"),
        )

    zero = F.lit(0).cast("long")
    met, alone, above = [], [], None
    left: DataFrame | None = None
    for at, low in zip(depths, [*depths[1:], -1], strict=True):
        # Conversations that end between two rounds end alone, in nodes without children.
        between = (F.col("depth") > at) & (F.col("depth") < above) if above is not None else F.col("depth") > at
        fresh = totals(classes.where(between).withColumns({"n_children": zero, "n_leaves": zero, "saved": zero}), at)
        alone.append(fresh)
        left = fresh if left is None else left.unionByName(fresh)
        # What lies between a node and its ancestor at this level has the node's members.
        saved = F.col("saved") + (F.col("n_convs") - 1) * (_points(F.col("depth") - 1) - _points(F.lit(at)))
        stripped = left.select(
            _key(F.lit(at)).alias("key"), F.slice("path", 1, at).alias("path"), "conv_id", "n_convs",
            F.lit(1).cast("long").alias("n_children"), "n_leaves", saved.alias("saved"),
        )
        ended = classes.where(F.col("depth") == at).select(
            "key", "path", "conv_id", "n_convs", zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved")
        )
        grouped = stripped.unionByName(ended).groupBy("key").agg(
            F.first("path").alias("path"), F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        )
        left = keep(totals(grouped.withColumn("depth", F.lit(at)), low), "trie-level")
        met.append(left)
        above = at
    met_nodes = reduce(DataFrame.unionByName, met)
    return _nodes(reduce(DataFrame.unionByName, alone, met_nodes), met_nodes, ends, left)


def _nodes(stretches: DataFrame, met: DataFrame, ends: DataFrame, root: DataFrame) -> DataFrame:
    """One row for every depth of each stretch ``(low, depth]`` of nodes with the same members."""
    stretches = stretches.join(dealt_anew(ends), "key", "left")
    # The parent of a stretch was met in a round; the root, parent of any number, is one row.
    top = root.select("conv_id").first()
    over_root = stretches.where("low <= 0").withColumn(
        "parent", F.when(F.col("low") == 0, F.lit(top.conv_id if top else None).cast("long"))
    )
    parents = met.where("depth > 0").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent"))
    inner = stretches.where("low > 0").withColumn("parent_key", _key(F.col("low"))).join(parents, "parent_key").drop("parent_key")
    rows = over_root.unionByName(inner)
    rows = rows.withColumn("at", F.explode(F.sequence(F.col("low") + 1, F.col("depth"))))
    is_top = F.col("at") == F.col("depth")
    return rows.select(
        "conv_id",
        F.col("at").cast("long").alias("depth"),
        F.when(F.col("at") == F.col("low") + 1, F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(is_top, F.col("n_children")).otherwise(F.lit(1).cast("long")).alias("n_children"),
        "n_leaves",
        (F.col("saved") + (F.col("n_convs") - 1) * (_points(F.col("depth") - 1) - _points(F.col("at") - 1))).alias("saved_tokens"),
        F.when(is_top & F.col("ends_sha256").isNotNull(), F.col("ends_sha256"))
        .otherwise(F.lit(hashlib.sha256(b"").hexdigest()))
        .alias("ends_sha256"),
    )
