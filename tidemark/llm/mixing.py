"""Mixing sources to target weights, with DataFrame functions only.

Temperature: a source's weight is its share of all tokens to the power of an exponent
between 0 (sources alike) and 1 (as they are). The exponent is bisected until the weights
have a target entropy, or until no source is repeated more often than a limit. Each source is
dealt by hash into blocks of some tokens; an epoch is a permutation of its blocks, and blocks
are taken, epoch after epoch, until the source's budget is met to within half a block. The
blocks of all sources are interleaved so that any stretch has the weights of the whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import keep
from tidemark.operators.rows import number_rows
from tidemark.session import BROADCAST_ROWS, has_at_most

#: Exponents are multiples of one part in so many, found four binary digits at a time.
GRID, _DIGITS = 1 << 16, 4
#: Fixed value of the SQL only, which takes larger blocks beyond so many; at the sizes it is run at it changes nothing.
MOST_BLOCKS = 1 << 16
_WORDS = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORDS)), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    """Text that tells sources apart, null from all others."""
    return F.when(source.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), source.cast("string")))


def _exponent(sources: DataFrame, target_entropy: float | None, max_repeats: float | None) -> int:
    """The exponent in parts of ``GRID``.

    Entropy falls with the exponent: the largest that still reaches the target. Repeats
    fall with it too: the smallest that keeps the limit.
    """
    share = F.col("tokens") / F.col("all_tokens")

    def fits(k: int) -> list[Column]:
        power = F.pow(share, F.lit(k / GRID))
        if max_repeats is not None:
            # With the largest source read once, the smallest is read this many times.
            return [F.pow(F.min(share) / F.max(share), F.lit(k / GRID - 1)) <= max_repeats]
        entropy = F.log(F.sum(power)) - F.lit(k / GRID) * F.sum(power * F.log(share)) / F.sum(power)
        return [entropy < target_entropy]

    # Invariant: at ``low`` the test fails, at ``high`` it holds.
    low, high = -1, GRID
    used = sources.where("tokens > 0")
    while high - low > 1:
        step = max(1, (high - low) >> _DIGITS)
        tries = list(range(low + step, high, step))
        (row,) = used.agg(*[c.alias(f"t{k}") for k in tries for c in fits(k)]).collect()
        held = [k for k in tries if row[f"t{k}"]]
        high = held[0] if held else high
        low = max([low, *[k for k in tries if k < high]])
    if max_repeats is not None:
        return high
    (row,) = used.agg(fits(GRID)[0].alias("t")).collect()
    return GRID if not row["t"] else max(high - 1, 0)


def plan_mix(
    df: DataFrame,
    source_col: str = "source",
    text_col: str = "text",
    id_col: str = "doc_id",
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    block_tokens: int = 1 << 14,
    seed: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """The sources with their weights, and the blocks to read with their places.

    ``(key, tokens, n_blocks, weight, budget)`` and ``(key, block, epoch, position)``.
    """
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give either a target entropy or a limit of repeats")
    if max_repeats is not None and max_repeats < 1:
        raise ValueError("every source is read once at least")
    rows = df.select(
        _source_key(F.col(source_col)).alias("key"), _row_hash(id_col, text_col, seed).alias("hash"), word_count(F.col(text_col)).alias("tokens")
    )
    rows = keep(rows, "mix-rows")
    sources = rows.groupBy("key").agg(F.sum("tokens").alias("tokens"))
    totals = sources.agg(F.sum("tokens").alias("all_tokens")).select(F.coalesce("all_tokens", F.lit(0)).alias("all_tokens"))
    (total,) = totals.collect()
    size = max(block_tokens, 1)
    n_blocks = F.greatest(F.ceil(F.col("tokens") / size), F.lit(1)).cast("long")
    sources = keep(sources.select("*", F.lit(total["all_tokens"]).alias("all_tokens"), n_blocks.alias("n_blocks")), "mix-sources")
    if total["all_tokens"]:
        power = F.lit(_exponent(sources, target_entropy, max_repeats) / GRID)
        raw = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.col("all_tokens"), power)).otherwise(0.0)
        (scale,) = sources.agg(F.sum(raw).alias("powers"), F.max(F.try_divide(F.col("tokens"), raw)).alias("once")).collect()
        weight = raw / F.lit(scale["powers"])
        # The source that the mix uses least is read once.
        budget = raw * F.lit(scale["once"])
    else:
        weight, budget = F.lit(0.0), F.lit(0.0)
    sources = sources.select("key", "tokens", "n_blocks", weight.alias("weight"), budget.alias("budget"))

    blocks = rows.join(_small(sources.select("key", "n_blocks")), "key")
    blocks = blocks.groupBy("key", _block().alias("block")).agg(F.sum("tokens").alias("block_tokens"))
    repeats = F.try_divide(F.col("budget"), F.col("tokens"))
    last = F.greatest(F.ceil(repeats - 1e-9).cast("long") - 1, F.lit(0).cast("long"))
    epochs = _small(sources).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    drawn = F.md5(F.concat_ws("|", F.lit(str(seed)), "epoch", "key", "block"))
    dealt = _with_tokens_before(blocks.join(epochs, "key").withColumn("drawn", drawn))
    middle = F.col("epoch") * F.col("tokens") + F.col("before") + F.col("block_tokens") / 2
    taken = dealt.withColumn("middle", middle).where("middle <= budget + 0.5")
    place = F.floor(F.lit(1e9) * F.col("middle") / F.greatest("budget", F.lit(1.0)))
    placed = taken.select("key", "block", "epoch", place.alias("place"))
    numbered = number_rows(placed, ["place", "key", "epoch", "block"], "position")
    return sources, numbered.select("key", "block", "epoch", "position")


def _with_tokens_before(dealt: DataFrame) -> DataFrame:
    """The blocks with ``before``: the tokens of those drawn before in the same epoch of the same source.

    Blocks are sorted in ranges of (source, epoch, draw), however many one source has; each range
    adds up its own, and a row for each range, source and epoch tells what lies before it.
    """
    order = ["key", "epoch", "drawn", "block"]
    ranged = keep(dealt.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "mix-ranges")
    until = (Window.unboundedPreceding, -1)
    inside = F.sum("block_tokens").over(Window.partitionBy("range", "key", "epoch").orderBy("drawn", "block").rowsBetween(*until))
    sums = ranged.groupBy("range", "key", "epoch").agg(F.sum("block_tokens").alias("tokens_here"))
    ahead = F.sum("tokens_here").over(Window.partitionBy("key", "epoch").orderBy("range").rowsBetween(*until))
    sums = sums.select("range", "key", "epoch", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    rows = ranged.withColumn("inside", F.coalesce(inside, F.lit(0))).join(_small(sums), ["range", "key", "epoch"])
    return rows.withColumn("before", F.col("ahead") + F.col("inside")).drop("range", "ahead", "inside")


def _row_hash(id_col: str, text_col: str, seed: int) -> Column:
    named = F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), named)), 1, 8), 16, 10).cast("long")


def _block() -> Column:
    return F.col("hash") % F.col("n_blocks")


def _small(df: DataFrame) -> DataFrame:
    """Broadcast if measured to be small; joined like any table otherwise."""
    return F.broadcast(df) if has_at_most(df, BROADCAST_ROWS) else df


def mix(
    df: DataFrame,
    source_col: str = "source",
    text_col: str = "text",
    id_col: str = "doc_id",
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    block_tokens: int = 1 << 14,
    seed: int = 0,
    prefix: str = "",
) -> DataFrame:
    """The rows of ``df`` as often as the mix reads them, with ``epoch, block, position``.

    Tokens are counted as words. Every source is read once at least, within half a block;
    ``position`` numbers the blocks in reading order; ``prefix`` goes before the three names. A null source is a source of its
    own; one without words is read once; a null or empty text counts no words and goes
    with its block. Rows repeated are read repeatedly. Columns of ``df`` named as the
    three new ones are replaced. An empty table gives an empty result.
    """
    sources, blocks = plan_mix(df, source_col, text_col, id_col, target_entropy, max_repeats, block_tokens, seed)
    new = {name: prefix + name for name in ("epoch", "block", "position")}
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in new.values()]).alias("row"),
        _source_key(F.col(source_col)).alias("key"),
        _row_hash(id_col, text_col, seed).alias("hash"),
    )
    rows = rows.join(_small(sources.select("key", "n_blocks")), "key").withColumn("block", _block())
    return rows.join(_small(blocks), ["key", "block"]).select("row.*", *[F.col(a).alias(b) for a, b in new.items()])


def in_reading_order(
    mixed: DataFrame, columns: list[str], id_col: str = "doc_id", seed: int = 0, prefix: str = ""
) -> DataFrame:
    """The given columns of mixed rows, block after block and shuffled within each."""
    position = f"{prefix}position"
    drawn = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(f"{prefix}epoch"), F.col(id_col).cast("string")))
    # The drawn order is computed anew for the sort, so that it takes no column's name.
    return mixed.repartitionByRange(position, drawn).sortWithinPartitions(position, drawn).select(*columns)
