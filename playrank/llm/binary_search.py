"""Exact top-k by Hamming distance over binary codes: incremental multi-index hashing.

A code is cut into segments. Two codes that differ in at most ``m * (r + 1) - 1`` bits agree to within r bits in one of the
m segments at least, so looking up each segment's values at growing radius r finds neighbours in order of coverage. A query is
done as soon as its k-th verified distance is covered; until then only queries still open take part in the next radius.

Codes are indexed per (segment, value prefix), about ``GROUP_CODES`` in each, and a query visits the prefixes within its radius.
Inside a group its probes are table lookups, or, where they outnumber the group's codes, a comparison with each. Equal codes are one entry (with their k smallest ids), so a code that a third of
the rows share costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playrank.llm.runs import key_runs, run_bounds
from playrank.operators.relational import top_k_per_group
from playrank.session import materialize

BITS = 64
GROUP_CODES = 4096
LITERALS = 512  # near prefixes written into a plan at most


def sign_code(vector: Column | str) -> Column:
    """Bit i of the code tells whether the i-th of the first 64 components is above zero; null for a null vector."""
    bit = lambda x, i: F.when((x > 0) & (i < BITS), F.expr("1L")).otherwise(F.expr("0L"))
    placed = F.transform(vector, lambda x, i: F.call_function("shiftleft", bit(x, i), i % BITS))
    return F.aggregate(placed, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))


def segment_bits(n: int) -> int:
    """Segments about as wide as the number of codes has bits; a divisor of 64."""
    return 8 if n < 1 << 12 else 16 if n < 1 << 24 else 32


def masks(bits: int, weight: int) -> np.ndarray:
    """All numbers of ``bits`` bits with ``weight`` of them set."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(bits), weight)], np.int64)


def _search(width: int, prefix_bits: int, radius: int, k: int):
    low_bits = width - prefix_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_weight: dict[int, np.ndarray] = {}
        for table in key_runs(batches, ["seg", "prefix"]):
            seg, prefix, query = (table[c].to_numpy() for c in ("seg", "prefix", "query"))
            code, least, bound = (table[c].to_numpy() for c in ("code", "least_id", "bound"))
            bounds = run_bounds(seg, prefix)
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                asked = np.flatnonzero(query[a:b]) + a
                held = np.flatnonzero(~query[a:b]) + a
                if not len(asked) or not len(held):
                    continue
                value = lambda rows, s=int(seg[a]): (code[rows].view(np.uint64) >> np.uint64(s * width)).astype(np.int64) & ((1 << width) - 1)
                low = value(held) & ((1 << low_bits) - 1)
                order = np.argsort(low, kind="stable")
                held, low = held[order], low[order]
                if low_bits <= 20:
                    starts = np.searchsorted(low, np.arange((1 << low_bits) + 1))
                own = value(asked)
                away = np.bitwise_count(((own >> low_bits) ^ int(prefix[a])).astype(np.uint64))
                for w in np.unique(away).tolist():
                    if w > radius or radius - w > low_bits:
                        continue
                    some = asked[away == w]
                    probing = comb(low_bits, radius - w) <= len(held)
                    if probing and radius - w not in by_weight:
                        by_weight[radius - w] = masks(low_bits, radius - w)
                    step = max(1, (1 << 20) // max(1, len(by_weight[radius - w]) if probing else len(held)))
                    for at in range(0, len(some), step):
                        part = some[at : at + step]
                        mine_low = value(part) & ((1 << low_bits) - 1)
                        if probing:
                            probes = (mine_low[:, None] ^ by_weight[radius - w][None, :]).ravel()
                            first, last = (starts[probes], starts[probes + 1]) if low_bits <= 20 else (np.searchsorted(low, probes), np.searchsorted(low, probes, "right"))
                            n = last - first
                            hit = np.flatnonzero(n)
                            count = n[hit]
                            offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                            rows = held[np.repeat(first[hit], count) + offset]
                            who = part[np.repeat(hit // len(by_weight[radius - w]), count)]
                        else:  # more probes than codes: compare with the codes themselves
                            one, other = np.nonzero(np.bitwise_count((mine_low[:, None] ^ low[None, :]).astype(np.uint64)) == radius - w)
                            who, rows = part[one], held[other]
                        if not len(rows):
                            continue
                        differ = code[who].view(np.uint64) ^ code[rows].view(np.uint64)
                        distance = np.bitwise_count(differ).astype(np.int64)
                        # A pair is reported where it is met first: at its smallest segment distance, the lowest such segment.
                        mine = int(seg[a])
                        new = distance <= bound[who]
                        for s in range(BITS // width):
                            d = np.bitwise_count((differ >> np.uint64(s * width)) & np.uint64((1 << width) - 1))
                            new &= (d > radius) if s < mine else (d >= radius)
                        rows, who, distance = rows[new], who[new], distance[new]
                        order = np.lexsort((least[rows], distance, who))
                        rows, who, distance = rows[order], who[order], distance[order]
                        runs = run_bounds(who)
                        place = np.arange(len(who)) - np.repeat(runs[:-1], np.diff(runs))
                        keep = place < k
                        if keep.any():
                            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (code[who], code[rows], distance)], ["query_code", "code", "distance"])

    return run


def search_codes(rows: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, id, distance): the k nearest rows of every query by Hamming distance, ties by smaller id.

    ``rows`` and ``queries`` are (id bigint, code bigint). Null ids or codes are left out on either side; a query meets
    itself if it is a row. Fewer than k rows give shorter lists, an empty side gives none. Repeated rows count as often
    as they stand there; other columns are left aside.
    """
    if k < 1:
        raise ValueError("k must be positive")
    spark = rows.sparkSession
    rows = rows.select(F.col("id").cast("bigint").alias("id"), F.col("code").cast("bigint").alias("code")).where("id IS NOT NULL AND code IS NOT NULL")
    queries = materialize(queries.select(F.col("id").cast("bigint").alias("query_id"), F.col("code").cast("bigint").alias("query_code")).where("query_id IS NOT NULL AND query_code IS NOT NULL"), "queries")
    members = materialize(top_k_per_group(rows, "code", [F.col("id").asc()], k, "nth"), "members")
    codes = materialize(members.groupBy("code").agg(F.min("id").alias("least_id"), F.count("*").alias("held")), "codes")
    total = codes.count()
    empty = "query_id bigint, rank int, id bigint, distance bigint"
    if not total:
        return spark.createDataFrame([], empty)

    width = segment_bits(total)
    m = BITS // width
    prefix_bits = min(width, max(0, (total // GROUP_CODES).bit_length()))
    value = F.expr(f"shiftrightunsigned(code, seg * {width}) & {(1 << width) - 1}L")
    segments = F.explode(F.array(*[F.lit(s) for s in range(m)])).alias("seg")
    head = F.shiftright(value, width - prefix_bits)
    index = codes.select("code", "least_id", segments).withColumn("prefix", head)
    index = materialize(index.select("seg", "prefix", F.lit(False).alias("query"), "code", "least_id", F.lit(0).cast("bigint").alias("bound")), "index")

    open_queries = materialize(queries.select(F.col("query_code").alias("code"), F.lit(BITS).cast("bigint").alias("bound")).distinct(), "open")
    found: DataFrame | None = None
    for radius in range(width + 1):
        if sum(comb(prefix_bits, w) for w in range(min(radius, prefix_bits) + 1)) <= LITERALS:
            near = np.concatenate([masks(prefix_bits, w) for w in range(min(radius, prefix_bits) + 1)])
            prefixes = F.transform(F.array(*[F.lit(int(x)) for x in near]), lambda x: head.bitwiseXOR(x.cast("bigint")))
        else:  # too many for a plan: of all prefixes those near enough
            every = F.sequence(F.lit(0).cast("bigint"), F.lit((1 << prefix_bits) - 1).cast("bigint"))
            prefixes = F.filter(every, lambda x, r=radius: F.bit_count(x.bitwiseXOR(head)) <= r)
        visits = open_queries.select("code", "bound", segments).withColumn("prefix", F.explode(prefixes))
        visits = visits.select("seg", "prefix", F.lit(True).alias("query"), "code", F.lit(0).cast("bigint").alias("least_id"), "bound")
        dealt = index.unionByName(visits).repartition("seg", "prefix").sortWithinPartitions("seg", "prefix")
        new = materialize(dealt.mapInArrow(_search(width, prefix_bits, radius, k), "query_code bigint, code bigint, distance bigint"), "found")
        found = new if found is None else found.unionByName(new)
        covered = m * (radius + 1) - 1
        if covered >= BITS:
            break
        # The k-th verified distance so far, rows of equal code counted; it bounds what later radii may still bring.
        counted = found.join(codes, "code").groupBy("query_code", "distance").agg(F.sum("held").alias("n"))
        upto = F.sum("n").over(W.partitionBy("query_code").orderBy("distance").rowsBetween(W.unboundedPreceding, 0))
        kth = counted.withColumn("upto", upto).where(F.col("upto") >= k).groupBy("query_code").agg(F.min("distance").alias("kth"))
        state = open_queries.join(kth, F.col("code") == F.col("query_code"), "left")
        open_queries = materialize(state.where(F.coalesce(F.col("kth") > covered, F.lit(True))).select("code", F.coalesce("kth", "bound").alias("bound")), "open")
        if open_queries.isEmpty():
            break
    # The k best codes hold the k best rows.
    best = top_k_per_group(found.join(codes.select("code", "least_id"), "code"), "query_code", [F.col("distance").asc(), F.col("least_id").asc()], k, "nth").drop("nth", "least_id")
    rows_of = best.join(members.select("code", "id"), "code").drop("code")
    ranked = top_k_per_group(rows_of, "query_code", [F.col("distance").asc(), F.col("id").asc()], k, "rank")
    return queries.join(ranked, "query_code").select("query_id", "rank", "id", "distance")

