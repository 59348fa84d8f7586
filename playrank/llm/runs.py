"""Groups and graph components for the operators that work on keyed rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playrank.session import materialize

HOT = 1000
LEAST_BITS, MOST_BITS = 16, 26
ROW = "__row"  # key of a row, for tables whose doc_id may repeat or be null


def keyed_rows(df: DataFrame) -> DataFrame:
    """``df`` with a key per row in ``ROW``, written, so that every later read sees the same keys."""
    return materialize(df.withColumn(ROW, F.monotonically_increasing_id()), "rows")


def join_by_share(left: DataFrame, right: DataFrame, keys: list[str], total: int, n: str = "n", how: str = "inner") -> DataFrame:
    """Join (inner or left) to a table that has each key once, ``n`` being the rows ``left`` has of it, ``total`` all of them.

    Keys with a share of 1/``HOT`` or more, ``HOT`` at most, are broadcast, so no key's rows have to meet in one task. The
    column ``n`` is left out.
    """
    often = F.col(n) * HOT >= F.lit(total)
    hot = F.broadcast(right.where(often).drop(n))
    rest = left.join(hot.select(*keys), keys, "left_anti")
    return left.join(hot, keys).unionByName(rest.join(right.where(~often).drop(n), keys, how))


def split_by_keys(rows: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that may have one of ``keys`` (a bigint hash each, in its first column), and rows that surely have none.

    Told apart where they are, by a bitmap of at most ``2**MOST_BITS`` bits that is broadcast; only the first kind has to
    be shuffled for an exact join. A crowded bitmap lets more rows be of the first kind, never fewer.
    """
    bits = min(MOST_BITS, max(LEAST_BITS, (keys.count() * 16).bit_length()))
    spread = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << bits)) + 1  # noqa: E731  Spark's bitmap positions count from one
    place = spread(F.col(keys.columns[0]))
    blocks = keys.groupBy(F.bitmap_bucket_number(place).alias("__block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("__bits"))
    tested = rows.withColumns({"__block": F.bitmap_bucket_number(spread(F.col(key))), "__bit": F.bitmap_bit_position(spread(F.col(key)))})
    tested = tested.join(F.broadcast(blocks), "__block", "left")
    byte = F.expr("CAST(conv(hex(substring(__bits, CAST(__bit div 8 + 1 AS INT), 1)), 16, 10) AS INT)")
    hit = F.coalesce(F.call_function("getbit", byte, F.expr("CAST(__bit % 8 AS INT)")) == 1, F.lit(False))
    return tested.where(hit).select(*rows.columns), tested.where(~hit).select(*rows.columns)


def key_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Complete runs of equal keys from batches sorted by ``keys`` (integer columns).

    What is yielded holds whole runs, mostly many of them; a run that crosses batches is put together first.
    """
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            values = batch.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
            change[0] |= not waiting or waiting[-1].column(k)[-1].as_py() != values[0]
        starts = np.flatnonzero(change)
        if not len(starts):
            waiting.append(batch)
            continue
        last = int(starts[-1])
        if last:
            waiting.append(batch.slice(0, last))
        if waiting:
            yield pa.Table.from_batches(waiting)
        waiting = [batch.slice(last)]
    if waiting:
        yield pa.Table.from_batches(waiting)


def run_bounds(*keys: np.ndarray) -> np.ndarray:
    """Start of each run of equal keys, and the length at the end."""
    n = len(keys[0])
    change = np.ones(n, bool)
    if n:
        change[1:] = False
        for values in keys:
            change[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(change), n)


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root): the smallest node reachable over ``edges`` (a, b), for every node of an edge.

    Alternates large and small stars: every round hangs neighbours on the smallest one, and the
    edge table never grows. Hot nodes are pre-aggregated, and their few least neighbours are broadcast.
    """
    current = materialize(edges.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        total = current.count()
        both = current.unionByName(current.selectExpr("b AS a", "a AS b"))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")
        large = join_by_share(both.where("b > a"), least, ["a"], total).selectExpr("b AS a", "m AS b").where("a <> b")
        large = materialize(large.distinct(), "edges")  # every edge points to a smaller node
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = join_by_share(large, least, ["a"], total).selectExpr("b AS a", "m AS b").where("a <> b").unionByName(least.selectExpr("a", "m AS b"))
        current = materialize(small.distinct(), "edges")
        state = current.agg(F.count("*"), F.sum(F.hash("a", "b").cast("bigint")), F.countDistinct("a")).first()
        if state == before and state[0] == state[2]:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return current.selectExpr("a AS node", "b AS root").unionByName(current.selectExpr("b AS node", "b AS root").distinct())
