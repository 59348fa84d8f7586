"""Mix sources to target weights: exact block quotas, split over the output shards by a hypergeometric tree.

Every source's documents stand in one seeded order, and that order is cut into ``BLOCKS`` blocks by hash prefix, so
taking blocks from the front is drawing blocks without replacement. A quota in words is a number of whole passes, a
number of whole blocks and a cut inside one block, which is found from prefix sums of sub-blocks; no source is ever
sorted as a whole. The blocks each source gives are then dealt to the shards: a tree splits the shards in halves and
draws, by the multivariate hypergeometric law, how many of each source's blocks go left. Inside a shard the order is
a seeded shuffle.

The driver holds one row per source (its size and quota), never documents.

The mix of texts follows from the same layout where the rows are: a row's draws depend on its own hash, its source's
blocks and, in the one block per source that the quota ends in, on a last hash. Texts are shuffled once, to their places.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playrank.operators.relational import lookup_join
from playrank.session import materialize

BLOCKS = 256  # two hex digits of the order; a source with a third of all rows gives as many
WORDS_PER_PART = 4_000_000  # of a shard, in one partition of the mix
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int], percent: int, most: int) -> DataFrame:
    """(source, source_size, target): ``percent`` of all sizes shared by weight, none above ``most`` times its size.

    Sources in code point order, null last, get the weights in turn. Excess is shared again by weight until nobody is
    above, which ends where every source holds the smaller of its limit and its weight times one common level. One row
    per source is all that the unpartitioned windows see.
    """
    turn = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), F.pmod(F.row_number().over(turn) - 1, F.lit(len(weights))) + 1)
    ranked = sizes.withColumn("w", weight).withColumn("limit", F.col("source_size") * F.lit(most))
    by_level = W.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    before, after = by_level.rowsBetween(W.unboundedPreceding, -1), by_level.rowsBetween(0, W.unboundedFollowing)
    whole = W.partitionBy()
    level = ranked.withColumns(
        {
            "total": F.sum("source_size").over(whole) * F.lit(percent) / F.lit(100.0),
            "full": F.coalesce(F.sum("limit").over(before), F.lit(0)),
            "open": F.sum("w").over(after),
        }
    ).withColumn("capped", F.col("limit") * F.col("open") <= F.col("w") * (F.col("total") - F.col("full")))
    spent = F.coalesce(F.sum(F.when(F.col("capped"), F.col("limit"))).over(whole), F.lit(0))
    rest = F.sum(F.when(~F.col("capped"), F.col("w"))).over(whole)
    target = F.when(F.col("capped"), F.col("limit").cast("double")).otherwise(F.col("w") * ((F.col("total") - spent) / rest))
    return level.select("source", "source_size", target.alias("target"))


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """(source, shard) counts with the given row sums and equal column sums, one apart at most."""
    counts = np.zeros((len(quotas), shards), np.int64)

    def split(left: int, right: int, pool: np.ndarray) -> None:
        if right - left == 1:
            counts[:, left] = pool
            return
        middle = (left + right) // 2
        total = int(pool.sum())
        share = total * (middle - left) // (right - left)
        # One colour after the other: the marginals of the multivariate law, exact at any size.
        taken, remaining, want = np.zeros_like(pool), total, share
        for k, have in enumerate(pool.tolist()):
            remaining -= have
            low = max(0, want - remaining)
            taken[k] = min(have, want) if low == min(have, want) else rng.hypergeometric(have, remaining, want) if have and want else 0
            want -= int(taken[k])
        split(left, middle, taken)
        split(middle, right, pool - taken)

    split(0, shards, quotas.astype(np.int64))
    return counts


def _order(seed: str) -> Column:
    """The hash that rows of a source stand in the order of; those without an id by their texts."""
    text = F.col("text").cast("string")
    return F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.md5(text))))


def _block(h: str) -> Column:
    return F.conv(F.substring(h, 1, 2), 16, 10).cast("int")


def _layout(docs: DataFrame, weights: Sequence[int], percent: int, most: int, shards: int, seed: str) -> tuple[DataFrame, DataFrame, int]:
    """What the mix takes, before any row is looked at on its own.

    Gives the rows without their texts, a row per source and block (the block's words, those before it, the source's
    quota, and where in the numbering of its blocks each shard ends), and the words of the whole mix.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    sized = docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        word_count(text).alias("size"),
        _order(seed).alias("h"),
        F.coalesce(F.crc32(text), F.lit(-1)).alias("crc"),
    )
    sized = materialize(sized.withColumns({"b": _block("h"), "c": F.substring("h", 3, 3)}), "sized")

    blocks = materialize(sized.groupBy("source", "b").agg(F.sum("size").alias("words")), "blocks")
    sizes = blocks.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, percent, most)
    quota = F.round("target").cast("bigint")
    passes = F.coalesce(F.try_divide(quota, "source_size").cast("bigint"), F.lit(0))
    quotas = materialize(targets.withColumn("passes", F.least(passes, F.lit(most))).withColumn("rest", quota - F.col("passes") * F.col("source_size")), "quotas")

    order = W.partitionBy("source").orderBy("b").rowsBetween(W.unboundedPreceding, -1)
    # ``i`` numbers a source's blocks with words without gaps; further passes go on where the last one ended.
    filled = F.when(F.col("words") > 0, 1)
    placed = blocks.withColumns({"before": F.coalesce(F.sum("words").over(order), F.lit(0)), "i": F.count(filled).over(order), "held": F.count(filled).over(W.partitionBy("source"))})
    same = lambda left, right: left["source"].eqNullSafe(right["source"])
    placed = placed.join(quotas, same(placed, quotas)).drop(quotas["source"])
    # Block numbers a source gives: all of them once per pass, then those the rest reaches into.
    reached = F.count(F.when(F.col("before") < F.col("rest"), filled)) + F.first("passes") * F.count(filled)
    given = placed.groupBy("source").agg(reached.alias("n"), F.first("target").alias("target")).orderBy(F.col("source").asc_nulls_last()).collect()  # one row per source
    counts = split_quotas(np.array([r["n"] for r in given], np.int64), shards, np.random.default_rng(abs(hash_seed(seed))))
    ends = [(r["source"], [int(x) for x in np.cumsum(c)[:-1]]) for r, c in zip(given, counts, strict=True)]
    deal = spark.createDataFrame(ends, "source string, ends array<bigint>")
    placed = placed.join(deal, same(placed, deal)).drop(deal["source"])
    return sized, materialize(placed, "placed"), int(sum(r["target"] or 0 for r in given))


def _cut() -> Column:
    """Whether a source's quota ends inside the block."""
    return (F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest"))


def _dealt(turn: Column, h: Column, seed: str) -> tuple[Column, Column]:
    """(shard, place) of a row's draw in a pass."""
    number = turn * F.col("held") + F.col("i")
    shard = F.size(F.filter("ends", lambda e: e <= number))
    return shard, F.md5(F.concat_ws("|", F.lit(seed), turn.cast("string"), h))


def mix_plan(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), percent: int = 150, most: int = 2, shards: int = 8, seed: str = "mix") -> DataFrame:
    """(doc_id, source, block, size, source_size, target, draws) for every row of ``docs`` (doc_id, text, source, ...).

    ``draws`` is an array of (pass, words, shard, place): what the mix takes of the document and where it goes, ``place``
    being its shuffled sort key inside the shard. ``words`` below ``size`` is a passage from the document's start; there
    is one such cut per source, so every source gives its target rounded to a word. A null text has size 0, a null source
    is one source; repeated rows are rows of their own; an empty table gives no rows. Other columns are left aside,
    whatever their names. A document of size 0 is never drawn. Documents without an id are ordered by their texts.
    """
    sized, placed, _ = _layout(docs, weights, percent, most, shards, seed)
    table = placed.withColumnRenamed("source", "s").withColumnRenamed("b", "bb")
    rows = sized.join(table, sized["source"].eqNullSafe(table["s"]) & (F.col("b") == F.col("bb"))).drop("s", "bb")
    inside = rows.where(_cut())
    parts = inside.groupBy("source", "c").agg(F.sum("size").alias("part_words"))
    parts = parts.select(F.col("source").alias("s"), F.col("c").alias("cc"), F.coalesce(F.sum("part_words").over(W.partitionBy("source").orderBy("c").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    inside = inside.join(parts, F.col("source").eqNullSafe(F.col("s")) & (F.col("c") == F.col("cc"))).drop("s", "cc")
    within = W.partitionBy("source", "c").orderBy("h", "size", "crc", "doc_id").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("before") + F.col("earlier") + F.coalesce(F.sum("size").over(within), F.lit(0))
    inside = inside.withColumn("partial", F.least(F.greatest(F.col("rest") - start, F.lit(0)), F.col("size"))).drop("earlier")
    outside = rows.where(~_cut()).withColumn("partial", F.when(F.col("before") < F.col("rest"), F.col("size")).otherwise(F.lit(0)))

    whole = F.transform(F.sequence(F.lit(0), F.lit(most)), lambda p: F.struct(p.alias("pass"), F.when(p < F.col("passes"), F.col("size")).when(p == F.col("passes"), F.col("partial")).otherwise(0).cast("bigint").alias("words")))

    def dealt(draw: Column) -> Column:
        shard, place = _dealt(draw["pass"], F.col("h"), seed)
        return F.struct(draw["pass"].alias("pass"), draw["words"].alias("words"), shard.alias("shard"), place.alias("place"))

    draws = F.transform(F.filter(whole, lambda d: d["words"] > 0), dealt)
    return outside.unionByName(inside).select("doc_id", "source", F.col("b").alias("block"), "size", "source_size", "target", draws.alias("draws"))


def hash_seed(seed: str) -> int:
    """A number for numpy from the text seed, the same in every process."""
    return int.from_bytes(seed.encode()[:16].ljust(16, b"\0"), "big")


def _last_hashes(sized: DataFrame, placed: DataFrame) -> DataFrame:
    """(source, b, last): in the block a source's quota ends in, the last hash whose rows are still drawn.

    Rows are drawn whole; those at the border are drawn if that comes nearer to the quota. Equal hashes (rows that repeat
    an id) are drawn together.
    """
    cuts = placed.where(_cut()).select(F.col("source").alias("s"), F.col("b").alias("bb"), "before", "rest")
    inside = sized.join(cuts, sized["source"].eqNullSafe(cuts["s"]) & (F.col("b") == F.col("bb"))).drop("s", "bb")
    units = inside.groupBy("source", "b", "c", "h").agg(F.sum("size").alias("size"), F.first("before").alias("before"), F.first("rest").alias("rest"))
    parts = units.groupBy("source", "c").agg(F.sum("size").alias("part_words"))
    earlier = F.coalesce(F.sum("part_words").over(W.partitionBy("source").orderBy("c").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(F.col("source").alias("s"), F.col("c").alias("cc"), earlier.alias("earlier"))  # 4,096 per source at most
    units = units.join(parts, F.col("source").eqNullSafe(F.col("s")) & (F.col("c") == F.col("cc")))
    within = F.coalesce(F.sum("size").over(W.partitionBy("source", "c").orderBy("h").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    left = F.col("rest") - F.col("before") - F.col("earlier") - within
    taken = units.withColumn("taken", 2 * left >= F.col("size"))
    return taken.where("taken").groupBy("source", "b").agg(F.max("h").alias("last"))


def mixed_documents(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), percent: int = 150, most: int = 2, shards: int = 8, seed: str = "mix", in_order: bool = False
) -> DataFrame:
    """The mix itself: the columns of ``docs`` plus ``_shard`` and ``_place``, one row per draw; with ``in_order`` shard by shard, each in its shuffled order.

    Every text is whole, so a source comes within half a document of its quota (rows with equal doc_id count as one).
    Rows that repeat an id are all drawn or none, and as often as the others of their source; those without an id are
    told apart by their texts. Texts without words are never drawn. All columns of the input are kept, whatever their
    names, but for ``_shard`` and ``_place``, which are replaced. An empty table gives no rows.
    """
    docs = docs.drop("_shard", "_place")
    sized, placed, words = _layout(docs, weights, percent, most, shards, seed)
    last = _last_hashes(sized, placed).select(F.col("source").alias("s"), F.col("b").alias("bb"), "last")
    marked = placed.join(last, placed["source"].eqNullSafe(last["s"]) & (F.col("b") == F.col("bb")), "left")
    key = F.concat(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")), F.lit("|"), F.col("b").cast("string"))
    table = materialize(marked.select(key.alias("key"), "before", "words", "rest", "passes", "held", "i", "ends", "last"), "marked")

    every = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = docs.where(F.col("text").cast("string").rlike(WORD)).select(every, F.col("source").cast("string").alias("source"), _order(seed).alias("h"))
    rows = lookup_join(rows.withColumn("b", _block("h")).withColumn("key", key), table, "key", "h", "inner")
    whole = F.when(_cut(), F.coalesce(F.col("h") <= F.col("last"), F.lit(False))).otherwise(F.col("before") < F.col("rest"))
    turns = F.filter(F.sequence(F.lit(0), F.lit(most)), lambda p: (p < F.col("passes")) | ((p == F.col("passes")) & whole))
    drawn = rows.withColumn("turn", F.explode(turns))
    shard, place = _dealt(F.col("turn"), F.col("h"), seed)
    drawn = drawn.select("doc", shard.alias("shard"), place.alias("place"))
    if in_order:
        # Places are hashes, so equal stretches of them hold about equally many rows.
        parts = max(1, -(-words // (shards * WORDS_PER_PART)))
        stretch = F.expr(f"CAST(conv(substring(place, 1, 6), 16, 10) AS BIGINT) * {parts} div {1 << 24}")
        drawn = drawn.withColumn("part", (F.col("shard") * parts + stretch).cast("int")).repartitionById(shards * parts, "part").sortWithinPartitions("shard", "place")
    return drawn.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns], F.col("shard").alias("_shard"), F.col("place").alias("_place"))
