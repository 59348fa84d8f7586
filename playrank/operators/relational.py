"""Ordering, top-k, de-duplication and lookup joins that hold up under hot keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playrank.session import materialize, own_shuffles

BROADCAST_BYTES = 64 << 20
SMALL_ROWS = 100_000
SALTS = 32
HEAVY = 100  # values with a hundredth of all rows are heavy
TASK_ROWS = 500_000  # rows that one task sorts or sums up


def top_k_per_group(df: DataFrame, group: str | Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows of every group. Spark prunes to k per group before the shuffle."""
    keys = [group] if isinstance(group, str) else list(group)
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def parts_for(spark: SparkSession, rows: int) -> int:
    """Partitions that so many rows need; 0 where the session's own number is enough."""
    parts = -(-rows // TASK_ROWS)
    return parts if parts > int(spark.conf.get("spark.sql.shuffle.partitions")) else 0


def deal(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    """Rows dealt by ``keys`` to that many partitions; as they are for 0."""
    return df.repartition(parts, *keys) if parts else df


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``, which must be total."""
    return top_k_per_group(df, keys, order, 1, "_rn").drop("_rn")


ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def _sorted_parts(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range-sorted copy with ``_part`` and the 1-based ``_row`` inside it."""
    numbered = materialize(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "sorted")
    row = F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + F.lit(1)
    return numbered.withColumns({"_part": F.shiftright(F.col("_id"), ROW_BITS), "_row": row}).drop("_id")


def _add_before(parts: DataFrame, weight: Column) -> DataFrame:
    """Add ``_before``: the weight of all earlier partitions; one row per partition is summed."""
    sizes = parts.groupBy("_part").agg(F.sum(weight).alias("_n"))
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return parts.join(F.broadcast(offsets), "_part")


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rn", small: int = SMALL_ROWS) -> DataFrame:
    """Exact 1-based row number over the whole table without a large single-task window.

    Range-sort, number the rows inside each partition, then add how many rows the earlier
    partitions hold; the only single-task step sees one row per partition. A table counted
    to be small is numbered by a plain window.
    """
    written = materialize(df, "unsorted")  # the range sort reads its input twice
    if written.count() <= small:
        return written.withColumn(name, F.row_number().over(W.orderBy(*order)).cast("bigint"))
    placed = _add_before(_sorted_parts(written, order), F.lit(1))
    return placed.withColumn(name, F.col("_before") + F.col("_row")).drop("_part", "_row", "_before")


def running_total(df: DataFrame, order: Sequence[Column], weight: str, name: str = "upto", small: int = SMALL_ROWS) -> DataFrame:
    """Exact inclusive running sum of an integer column over the whole table, made likewise."""
    written = materialize(df, "unsorted")
    if written.count() <= small:
        return written.withColumn(name, F.sum(weight).over(W.orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))
    placed = _add_before(_sorted_parts(written, order), F.col(weight))
    inside = W.partitionBy("_part").orderBy("_row").rowsBetween(W.unboundedPreceding, 0)
    total = F.col("_before") + F.sum(weight).over(inside)
    return placed.withColumn(name, total).drop("_part", "_row", "_before")


def cut_by_order(df: DataFrame, coarse: Column, order: Sequence[Column], cuts: Sequence[Callable[[Column], Column]]) -> DataFrame:
    """Add ``segment``: how many of the ascending cut positions lie at or before the row.

    Each cut maps the table's row count to a position; the first that many rows in ``order``
    lie below the cut. ``coarse`` is a key of limited range that never decreases along
    ``order`` (a day, a hash prefix). Its counts locate the cuts, so only the rows of the
    coarse values a cut falls into are sorted; all others are placed by comparison. The
    input is read three times: hand over a written table, not a costly plan. Rows without
    a coarse key come last; no row is lost.
    """
    keyed = df.withColumn("_coarse", coarse)
    counts = keyed.groupBy("_coarse").agg(F.count(F.lit(1)).alias("_n"))
    upto = W.orderBy(F.col("_coarse").asc_nulls_last()).rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy()
    counts = counts.select(
        "_coarse", "_n", F.sum("_n").over(upto).alias("_upto"), F.sum("_n").over(whole).alias("_total")
    )
    positions = counts.select(
        "*", F.posexplode(F.array(*[c(F.col("_total")).cast("bigint") for c in cuts])).alias("_cut", "_pos")
    )
    hits = positions.where((F.col("_pos") > F.col("_upto") - F.col("_n")) & (F.col("_pos") <= F.col("_upto")))
    found = {r["_cut"]: r for r in hits.collect()}  # one row per cut at most

    # A cut that no value contains lies before the first row: its position is zero.
    edges = sorted({r["_coarse"] for r in found.values()}, key=lambda e: (e is None, e))
    if not edges:
        return keyed.drop("_coarse").withColumn("segment", F.lit(len(cuts)))
    preceding, rows_before = {}, 0
    sizes = {r["_coarse"]: r["_n"] for r in found.values()}
    for edge in edges:
        preceding[edge] = rows_before
        rows_before += sizes[edge]

    def passed(condition_of: Callable[[object, int], Column]) -> Column:
        below = len(cuts) - len(found)
        terms = [condition_of(r["_coarse"], r["_pos"] - (r["_upto"] - r["_n"])).cast("int") for r in found.values()]
        return reduce(lambda a, b: a + b, terms, F.lit(below))

    def beyond(edge: object, _: int) -> Column:
        return F.lit(False) if edge is None else F.coalesce(F.col("_coarse") > F.lit(edge), F.lit(True))

    on_edge = reduce(lambda a, b: a | b, [F.col("_coarse").isNull() if e is None else F.col("_coarse").eqNullSafe(F.lit(e)) for e in edges])
    clear = keyed.where(~on_edge).withColumn("segment", passed(beyond))
    ranked = global_rank(keyed.where(on_edge), order, "_rn")
    ranked = ranked.withColumn("segment", passed(lambda edge, keep: F.col("_rn") > F.lit(preceding[edge] + keep)))
    return clear.drop("_coarse").unionByName(ranked.drop("_rn", "_coarse"))


def shuffled_join(left: DataFrame, right: DataFrame, keys: str | list[str], how: str = "inner") -> DataFrame:
    """Join two tables that both grow with the users; neither is gathered.

    Left to itself Spark goes by compressed files, and takes an exploded table for as small as what it was made of, so it
    would broadcast tables of millions of rows.
    """
    return left.join(right.hint("merge"), keys, how)


def row_bytes(schema: T.StructType) -> Column:
    """Estimated width of a row: what varies is measured, the rest counts 8 bytes a value."""

    def width(value: Column, kind: T.DataType) -> Column:
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(value), F.lit(0)) + 16
        if isinstance(kind, T.ArrayType):
            each = 32 if isinstance(kind.elementType, (T.StringType, T.BinaryType)) else 8
            return F.coalesce(F.size(value), F.lit(0)) * each + 16
        return F.lit(64 if isinstance(kind, (T.MapType, T.StructType)) else 8)

    return reduce(lambda a, b: a + b, [width(F.col(f"`{f.name}`"), f.dataType) for f in schema.fields], F.lit(8))


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the rows are at most ``limit`` bytes, measured by one partial sum per task."""
    with own_shuffles(df.sparkSession):
        return (df.agg(F.sum(row_bytes(df.schema).cast("bigint"))).first()[0] or 0) <= limit


def lookup_join(left: DataFrame, right: DataFrame, key: str, spread: str, how: str = "left", limit: int = BROADCAST_BYTES, told: DataFrame | None = None, write: bool = False) -> DataFrame:
    """Join a large side to a lookup table by ``key``.

    The lookup side is broadcast only if its measured bytes fit. Otherwise both sides are shuffled and only heavy keys are
    salted, so that a key holding a large share of the rows still lands in many tasks and the lookup side is not repeated.
    The heavy keys are looked for in ``told``, a table at hand with the left side's keys, or else in the left side itself,
    which is written first (``write``) where it is costly to make twice.
    """
    if fits_broadcast(right, limit):
        return left.join(F.broadcast(right), key, how)
    if write:
        left = materialize(left, "lookup")
    return skewed_join(left, right, key, spread, how, told)


def heavy_values(df: DataFrame, key: str, share: int = HEAVY) -> list:
    """Values that hold about a share of 1/``share`` of all rows or more, from a sketch of bounded size; nulls left out.

    Each task keeps a sketch of its most frequent values and the sketches are merged, so no value is counted by itself.
    """
    with own_shuffles(df.sparkSession):
        found = df.agg(F.count(key).alias("n"), F.call_function("approx_top_k", F.col(key), F.lit(2 * share), F.lit(32 * share)).alias("top")).first()
    return [r["item"] for r in found["top"] or [] if r["item"] is not None and r["count"] * share >= found["n"]]


def skewed_join(left: DataFrame, right: DataFrame, key: str, spread: str, how: str = "left", told: DataFrame | None = None) -> DataFrame:
    """Join a large side to a table with unique ``key`` that may be large too; only heavy keys are salted.

    Rows of a heavy value, and rows without one, are spread over the salts by ``spread``; the right side's rows of heavy
    values, ``HEAVY`` times two at most, are repeated once per salt. All other keys meet as in any join. Heavy values are
    those of ``told``, by default of the left side.
    """
    heavy = heavy_values(left if told is None else told, key)
    is_heavy = F.col(key).isin(heavy) if heavy else F.lit(False)
    salt = F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")
    salted_left = left.withColumn("_salt", F.when(F.col(key).isNull() | is_heavy, salt).otherwise(F.lit(0)))
    salts = F.when(is_heavy, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return shuffled_join(salted_left, right.withColumn("_salt", F.explode(salts)), [key, "_salt"], how).drop("_salt")
