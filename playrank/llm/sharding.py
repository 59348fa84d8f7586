"""Shards of equal bytes by sampled splitters, with DataFrame functions only.

1. A size-weighted sample of keys is drawn by hash, so reruns draw the same one; its quantiles are the splitters of
   ``RANGES`` key ranges. The driver holds that sample (about ``RANGES * DRAWS`` keys at any input size).
2. Exact bytes per range are counted. An overfull range gets splitters of its own from a second sample drawn only in it;
   those stay in a table and are joined by range.
3. Records are range-partitioned once, texts included. Inside a range a running sum of bytes gives each record's exact
   place in the whole order, and so its shard: shards differ by less than one record.

The order is (hash of the text, doc_id, checksum), so equal texts stand together. A border between shards is moved to the
edge of a group of equal texts where the group is small against a shard (``1 / WHOLE``); only a larger group is cut between
its documents.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playrank.session import materialize, new_path

RANGES = 256
DRAWS = 16  # sampled keys per range
WHOLE = 32
PIECE_BYTES = 32 << 20  # a range above twice this, or above twice its fair share, is subdivided

KEY = ["__key", "__id", "__crc"]
KEY_TYPE = "struct<__key:bigint,__id:bigint,__crc:bigint>"


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(1)).cast("bigint")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    return docs.withColumns({"__key": F.xxhash64(text), "__id": F.col("doc_id").cast("bigint"), "__crc": crc, "__size": record_size(text)})


def _drawn(rows: DataFrame, draws: Column, total: Column, salt: str) -> DataFrame:
    """Rows drawn with probability ``size * draws / total``; ``w`` is how many draws a larger row stands for."""
    share = F.col("__size") * draws / total
    chance = F.pmod(F.xxhash64(F.lit(salt), *KEY), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return rows.where(chance < share).withColumn("w", F.greatest(F.lit(1.0), share))


def _count_below(splitters: Column, n: Column, steps: int) -> Column:
    """How many of the ascending splitters lie at or below the row's key, by binary search."""
    key = F.struct(*KEY)

    def step(at: Column, jump: Column) -> Column:
        tried = at + jump
        return F.when((tried <= n) & (F.get(splitters, tried - 1) <= key), tried).otherwise(at)

    return F.aggregate(F.array(*[F.lit(1 << k) for k in reversed(range(steps))]), F.lit(0), step)


def shard_records(docs: DataFrame, shards: int = 8, ranges: int = RANGES, piece_bytes: int = PIECE_BYTES, path: str | None = None) -> DataFrame:
    """Write every row of ``docs`` (doc_id, text, ...) to folders ``_shard=0..`` and read them: all columns plus _size, _shard, _slot.

    Size is the text's UTF-8 bytes plus one, so null and empty texts weigh 1. ``_slot`` counts from 0 without gaps inside
    a shard, in key order. Rows of equal text share a shard unless they hold more than ``1 / WHOLE`` of one (about a range's
    share with many ranges). Equal rows are interchangeable, null ids come first within equal texts, an empty table gives
    no rows. Input columns called _size, _shard, _slot or like the working ``__`` columns are replaced.
    """
    if shards < 1 or ranges < 1:
        raise ValueError("shards and ranges must be positive")
    working = [*KEY, "__size", "_size", "_shard", "_slot", "__range", "__sub", "__held", "__from"]
    keep = [c for c in docs.columns if c not in working]
    records = _keyed(docs.select(*keep))
    keys = materialize(records.select(*KEY, "__size"), "keys")
    total = keys.agg(F.sum("__size")).first()[0] or 0
    path = path or new_path(docs.sparkSession, "shards")

    # First level: weighted quantiles of a sample of bounded size.
    sample = _drawn(keys, F.lit(float(ranges * DRAWS)), F.lit(float(max(total, 1))), "first").groupBy(*KEY).agg(F.sum("w").alias("w"))
    upto = F.sum("w").over(W.orderBy(*KEY).rowsBetween(W.unboundedPreceding, 0))
    whole = F.sum("w").over(W.partitionBy())
    quantile = F.floor(upto * ranges / whole)
    edges = sample.select(*KEY, quantile.alias("q"), F.floor((upto - F.col("w")) * ranges / whole).alias("q0"))
    chosen = edges.where((F.col("q") > F.col("q0")) & (F.col("q") < ranges)).orderBy(*KEY).collect()  # below ``ranges`` rows

    # A splitter whose text is no other splitter's stands before all rows of the text, so only large groups are split.
    shared = Counter(row["__key"] for row in chosen)

    def literal(row) -> Column:
        inside = shared[row["__key"]] > 1
        return F.struct(*[F.lit(row[c] if inside or c == "__key" else None).cast("bigint").alias(c) for c in KEY])

    first = F.array(*[literal(r) for r in chosen]) if chosen else F.array().cast(f"array<{KEY_TYPE}>")
    range_of = _count_below(first, F.lit(len(chosen)), max(1, len(chosen).bit_length()))

    # Second level: splitters for overfull ranges from a sample of their own.
    ranged = keys.withColumn("__range", range_of)
    sizes = ranged.groupBy("__range").agg(F.sum("__size").alias("bytes"))
    fair = min(2 * piece_bytes, max(1, 2 * total // ranges))
    overfull = sizes.where(F.col("bytes") > fair).withColumn("pieces", F.ceil(F.col("bytes") * 2 / fair).cast("int"))
    inner = _drawn(ranged.join(overfull, "__range"), F.col("pieces") * DRAWS, F.col("bytes"), "second")
    turn = W.partitionBy("__range").orderBy(*KEY)
    inner = inner.withColumn("nth", F.row_number().over(turn)).where(F.col("nth") % DRAWS == 0)
    inner = inner.withColumn("inside", F.count("*").over(W.partitionBy("__range", "__key")) > 1)
    inner = inner.withColumns({c: F.when(F.col("inside"), F.col(c)) for c in KEY[1:]})
    finer = inner.groupBy("__range").agg(F.array_sort(F.collect_set(F.struct(*KEY))).alias("inner"))
    finer = materialize(finer, "splitters")

    def placed(rows: DataFrame) -> DataFrame:
        both = rows.withColumn("__range", range_of).join(finer, "__range", "left")
        sub = F.coalesce(_count_below(F.col("inner"), F.size("inner"), 20), F.lit(0))
        return both.withColumn("__sub", F.when(F.col("inner").isNull(), 0).otherwise(sub)).drop("inner")

    pieces = placed(keys).groupBy("__range", "__sub").agg(F.sum("__size").alias("bytes"), F.count("*").alias("rows"))
    pieces = materialize(pieces, "pieces")
    in_range = W.partitionBy("__range").orderBy("__sub").rowsBetween(W.unboundedPreceding, -1)
    by_range = W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    starts = pieces.groupBy("__range").agg(F.sum("bytes").alias("b"), F.sum("rows").alias("n"))
    starts = starts.select("__range", F.coalesce(F.sum("b").over(by_range), F.lit(0)).alias("b0"), F.coalesce(F.sum("n").over(by_range), F.lit(0)).alias("n0"))
    before = pieces.select("__range", "__sub", *[F.coalesce(F.sum(c).over(in_range), F.lit(0)).alias(a) for c, a in (("bytes", "b1"), ("rows", "n1"))])
    offsets = before.join(starts, "__range").select("__range", "__sub", (F.col("b0") + F.col("b1")).alias("__bytes"), (F.col("n0") + F.col("n1")).alias("__rows"))

    # The one shuffle of whole records.
    piece = W.partitionBy("__range", "__sub").orderBy(*KEY)
    ordered = placed(records).withColumns({"__nth": F.row_number().over(piece), "__upto": F.sum("__size").over(piece.rowsBetween(W.unboundedPreceding, 0))})
    group = W.partitionBy("__range", "__sub", "__key")
    ordered = ordered.withColumns({"__held": F.sum("__size").over(group), "__from": F.min(F.col("__upto") - F.col("__size")).over(group)})
    joined = ordered.join(offsets, ["__range", "__sub"])
    of_row = 2 * (F.col("__bytes") + F.col("__upto")) - F.col("__size")
    of_group = 2 * (F.col("__bytes") + F.col("__from")) + F.col("__held")
    middle = F.when(F.col("__held") * F.lit(shards * WHOLE) <= F.lit(total), of_group).otherwise(of_row)
    shard = F.least(F.lit(shards - 1), F.floor(middle * F.lit(shards) / F.lit(2 * max(total, 1)))).cast("int")
    out = joined.select(*keep, F.col("__size").alias("_size"), (F.col("__rows") + F.col("__nth") - 1).alias("__row"), shard.alias("_shard"))
    out.write.partitionBy("_shard").parquet(path)
    written = docs.sparkSession.read.schema(out.schema).parquet(path)
    firsts = written.groupBy("_shard").agg(F.min("__row").alias("__first"))  # one row per shard
    return written.join(F.broadcast(firsts), "_shard").withColumn("_slot", F.col("__row") - F.col("__first")).select(*keep, "_size", "_shard", "_slot")
