"""Exact top-k scoring of user vectors against item vectors, skipping what cannot reach a list.

Inside a task the items stand in groups of near vectors. A group's centre, radius, greatest length and greatest bias bound
every score in it, so a user skips the groups that cannot beat its k-th score so far. Where the items make several
blocks, the block of the longest vectors goes first, and users meet only those further blocks whose bound can still beat
their k-th score. Bounds decide only what is left out unseen; results are those of scoring everything.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playrank.functions.arrow import matrix
from playrank.functions.vectors import l2_normalize, mean_vector
from playrank.operators.relational import fits_broadcast, lookup_join, top_k_per_group
from playrank.session import materialize

BLOCK_ITEMS = 200_000  # items whose vectors a task holds together; 102 MB at 64 dimensions. Users are sent once per block
GROUP_ITEMS = 128
ITEM_COPIES = 2_000_000  # item rows sent in all, unless every core needs a copy of its own
USERS_AT_ONCE = 2048
ROUNDING = 1e-9  # by which bounds are widened
ITEM, USER, SEEN = 0, 1, 2  # kinds of rows that a task gets


@dataclass(frozen=True)
class Groups:
    """Items of a block in groups of near vectors."""

    members: list[np.ndarray]  # places of the items, rising
    vectors: list[np.ndarray]
    biases: list[np.ndarray]
    centre: np.ndarray
    radius: np.ndarray
    length: np.ndarray
    bias: np.ndarray
    n: int


def group_items(vectors: np.ndarray, bias: np.ndarray) -> Groups:
    """Bands of like length, in each of which an item joins the nearest of some pivots."""
    n = len(vectors)
    lengths = np.linalg.norm(vectors, axis=1)
    wanted = max(1, n // GROUP_ITEMS)
    members: list[np.ndarray] = []
    for band in np.array_split(np.argsort(-lengths, kind="stable"), max(1, round(wanted**0.5))):
        held = vectors[band]
        pivots = held[np.linspace(0, len(band) - 1, max(1, len(band) // GROUP_ITEMS)).astype(np.int64)]
        nearest = np.empty(len(band), np.int64)
        for at in range(0, len(band), 4096):
            nearest[at : at + 4096] = (np.square(pivots).sum(1) - 2.0 * (held[at : at + 4096] @ pivots.T)).argmin(1)
        members += [np.sort(band[nearest == g]) for g in np.unique(nearest)]
    centre = np.stack([vectors[m].mean(0) for m in members])
    radius = np.array([np.linalg.norm(vectors[m] - c, axis=1).max() for m, c in zip(members, centre, strict=True)])
    return Groups(members, [vectors[m] for m in members], [bias[m] for m in members], centre, radius, np.array([lengths[m].max() for m in members]), np.array([bias[m].max() for m in members]), n)


def _cut(rows: np.ndarray, cols: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The k best entries of every row, in order, and their places from 0; ties go to the lower column."""
    order = np.lexsort((cols, -scores, rows))
    rows, cols, scores = rows[order], cols[order], scores[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    keep = place < k
    return rows[keep], cols[keep], scores[keep], place[keep]


def pruned_top_k(users: np.ndarray, groups: Groups, k: int, seen: np.ndarray, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """(row, column, score, place) of every user's k best items, and how many (user, group) pairs were skipped.

    ``seen`` holds ``row * n + column`` of what is left out, sorted; what scores below a user's ``floor`` is left out too.
    """
    m = len(users)
    length = np.linalg.norm(users, axis=1)[:, None]
    bound = np.minimum(users @ groups.centre.T + length * groups.radius, length * groups.length) + groups.bias
    bound += ROUNDING * (1.0 + np.abs(bound))
    kth = np.full(m, -np.inf) if floor is None else floor.copy()
    found = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    waiting: list[tuple] = []
    held = skipped = 0

    def settle() -> None:
        """Raise the k-th scores and let go of what lies below them."""
        nonlocal found, waiting, held
        rows, cols, scores = (np.concatenate([p[c] for p in [found, *waiting]]) for c in range(3))
        order = np.argsort(rows.astype(np.uint16), kind="stable")  # USERS_AT_ONCE rows at most
        rows, cols, scores = rows[order], cols[order], scores[order]
        count = np.bincount(rows, minlength=m)
        if len(rows) and count.max() >= k:
            table = np.full((m, int(count.max())), -np.inf)
            table[rows, np.arange(len(rows)) - (np.cumsum(count) - count)[rows]] = scores
            np.maximum(kth, -np.partition(-table, k - 1, axis=1)[:, k - 1], out=kth)
            keep = scores >= kth[rows]
            rows, cols, scores = rows[keep], cols[keep], scores[keep]
        if len(rows) > 4 * m * k:  # ties that no list has room for
            rows, cols, scores, _ = _cut(rows, cols, scores, k)
        found, waiting, held = (rows, cols, scores), [], 0

    def unseen(row: np.ndarray, col: np.ndarray) -> np.ndarray:
        key = row * groups.n + col
        return seen[np.minimum(np.searchsorted(seen, key), len(seen) - 1)] != key if len(seen) else np.ones(len(row), bool)

    order = np.argsort(-bound.mean(0), kind="stable")
    # All users meet the first groups, enough of them for a first k-th score.
    start = int(np.searchsorted(np.cumsum([len(groups.members[g]) for g in order]), min(4 * k, groups.n))) + 1
    cols = np.concatenate([groups.members[g] for g in order[:start]])
    scores = np.concatenate([users @ groups.vectors[g].T + groups.biases[g] for g in order[:start]], axis=1)
    if len(seen):
        where = np.full(groups.n, -1)
        where[cols] = np.arange(len(cols))
        place = where[seen % groups.n]
        scores[(seen // groups.n)[place >= 0], place[place >= 0]] = -np.inf
    if scores.shape[1] > k:
        least = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        row, col = np.nonzero((scores >= np.maximum(least, kth[:, None])) & np.isfinite(scores))
    else:
        row, col = np.nonzero((scores >= kth[:, None]) & np.isfinite(scores))
    waiting.append((row, cols[col], scores[row, col]))
    settle()
    for g in order[start:]:
        active = np.flatnonzero(bound[:, g] >= kth)
        skipped += m - len(active)
        if not len(active):
            continue
        scores = (users if len(active) == m else users[active]) @ groups.vectors[g].T + groups.biases[g]
        row, col = np.nonzero(scores >= kth[active][:, None])
        value, row, col = scores[row, col], active[row], groups.members[g][col]
        fresh = unseen(row, col)
        waiting.append((row[fresh], col[fresh], value[fresh]))
        held += int(fresh.sum())
        if held > m * k:
            settle()
    settle()
    return *_cut(*found, k), skipped


def _task(k: int):
    """Top k of the users of a task, block by block: a block's items stand first, then each user before what it has seen."""

    def score(ready: tuple, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        item_ids, groups = ready
        kind = rows["kind"].to_numpy()
        at = np.flatnonzero(kind == USER)
        if not len(at):
            return
        asked = rows.take(pa.array(at))
        names = asked["user_id"].combine_chunks()
        vectors = matrix(asked["vec"])
        floor = asked["bias"].fill_null(-np.inf).to_numpy()
        owner = np.cumsum(kind == USER) - 1
        listed = np.flatnonzero((kind == SEEN) & (owner >= 0))
        marks = rows.take(pa.array(listed))
        same = pc.fill_null(pc.equal(marks["user_id"].combine_chunks(), names.take(pa.array(owner[listed]))), False)
        place = pc.index_in(marks["item_id"].combine_chunks(), item_ids)
        known = np.flatnonzero(pc.and_(same, place.is_valid()).to_numpy(zero_copy_only=False))
        who, what = owner[listed][known], place.fill_null(0).to_numpy(zero_copy_only=False)[known].astype(np.int64)
        seen = np.unique(who * groups.n + what)
        for start in range(0, len(at), USERS_AT_ONCE):
            stop = min(start + USERS_AT_ONCE, len(at))
            mine = seen[np.searchsorted(seen, start * groups.n) : np.searchsorted(seen, stop * groups.n)] - start * groups.n
            row, col, value, nth, _ = pruned_top_k(vectors[start:stop], groups, k, mine, floor[start:stop])
            found = [names.take(pa.array(row + start)), pa.array((nth + 1).astype(np.int32)), item_ids.take(pa.array(col)), pa.array(value)]
            yield pa.RecordBatch.from_arrays(found, ["user_id", "rank", "item_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, items, ready, waiting = None, [], None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            change = np.flatnonzero((blocks[1:] != blocks[:-1]) | ((kinds[1:] == ITEM) != (kinds[:-1] == ITEM))) + 1
            bounds = [0, *change.tolist(), batch.num_rows]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if int(blocks[a]) != block:
                    if waiting and ready:
                        yield from score(ready, pa.Table.from_batches(waiting))
                    block, items, ready, waiting = int(blocks[a]), [], None, []
                if kinds[a] == ITEM:
                    items.append(batch.slice(a, b - a))
                    continue
                if ready is None and items:  # at most a block of items
                    table = pa.Table.from_batches(items)
                    ready = table["item_id"].combine_chunks(), group_items(matrix(table["vec"]), table["bias"].to_numpy())
                waiting.append(batch.slice(a, b - a))
                users = np.flatnonzero(kinds[a:b] == USER)
                # The last user's list may go on in the next batch.
                if ready and len(users) and sum(w.num_rows for w in waiting) >= USERS_AT_ONCE:
                    cut = int(users[-1])
                    yield from score(ready, pa.Table.from_batches([*waiting[:-1], waiting[-1].slice(0, cut)]))
                    waiting = [waiting[-1].slice(cut)]
        if waiting and ready:
            yield from score(ready, pa.Table.from_batches(waiting))

    return run


def _length(vector: str) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x))


def score_top_k(users: DataFrame, items: DataFrame, k: int, seen: DataFrame | None = None) -> DataFrame:
    """(user_id, rank, item_id, score) by ``vec . vec + bias``, seen items left out.

    ``users`` is (user_id, vec); ``items`` is (item_id, vec[, bias]); ``seen`` may name other users and items too. Items
    are dealt by length into blocks of about ``BLOCK_ITEMS`` and users into parts by id. Items, users and what they have
    seen meet as rows of one shuffle, so neither side is gathered anywhere and a task holds one block. With several
    blocks, users first meet that of the longest vectors and then only those that can still change their lists.
    """
    spark = users.sparkSession
    user_type, item_type = users.schema["user_id"].dataType, items.schema["item_id"].dataType
    if "bias" not in items.columns:
        items = items.withColumn("bias", F.lit(0.0))
    items = items.select("item_id", F.col("vec").cast("array<double>").alias("vec"), F.col("bias").cast("double").alias("bias"))
    items = materialize(items, "scored_items")
    absent = lambda c, kind: F.lit(None).cast(kind).alias(c)
    users = users.select("user_id", F.col("vec").cast("array<double>").alias("vec"))
    no_floor = absent("floor", "double")
    seen = seen.select("user_id", "item_id") if seen is not None else spark.createDataFrame([], T.StructType([T.StructField("user_id", user_type), T.StructField("item_id", item_type)]))
    n_items = items.count()  # from the files' footers
    schema = T.StructType([T.StructField("user_id", user_type), T.StructField("rank", T.IntegerType()), T.StructField("item_id", item_type), T.StructField("score", T.DoubleType())])
    if n_items == 0:
        return spark.createDataFrame([], schema)
    n_blocks = -(-n_items // BLOCK_ITEMS)
    # Tasks stream their users, so parts need not follow their number; each part gets a copy of the items.
    n_parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(spark.sparkContext.defaultParallelism, ITEM_COPIES // n_items))
    part = F.pmod(F.xxhash64("user_id"), F.lit(n_parts)).cast("int")
    parts = F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1)))

    def meet(items: DataFrame, users: DataFrame, seen: DataFrame, blocks: int) -> DataFrame:
        """All take a ``block``; the best k of each user in each block, but for what scores below the user's ``floor``."""
        item_rows = items.select("block", parts.alias("part"), F.lit(ITEM).alias("kind"), absent("user_id", user_type), "item_id", "vec", "bias")
        user_rows = users.select("block", part.alias("part"), F.lit(USER).alias("kind"), "user_id", absent("item_id", item_type), "vec", F.col("floor").alias("bias"))
        seen_rows = seen.select("block", part.alias("part"), F.lit(SEEN).alias("kind"), "user_id", "item_id", absent("vec", "array<double>"), absent("bias", "double"))
        rows = item_rows.unionByName(user_rows).unionByName(seen_rows).withColumn("task", (F.col("part") * blocks + F.col("block")).cast("int"))
        rows = rows.repartitionById(n_parts * blocks, "task").drop("task", "part")
        return rows.sortWithinPartitions("block", F.col("kind") != ITEM, "user_id", "kind", "item_id").mapInArrow(_task(k), schema)

    if n_blocks == 1:
        one = F.lit(0).alias("block")
        seen = seen.join(F.broadcast(items.select("item_id")), "item_id", "left_semi")  # a block's ids at most
        return meet(items.select("*", one), users.select("*", one, no_floor), seen.select("*", one), 1)

    # Blocks by length and bias; where the cuts lie decides speed alone.
    placed = items.withColumn("reach", _length("vec") + F.abs("bias"))
    cuts = placed.agg(F.percentile_approx("reach", [1 - (b + 1) / n_blocks for b in range(n_blocks - 1)], 10_000)).first()[0]
    block = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: F.col("reach") < c))
    placed = materialize(placed.withColumn("block", block).drop("reach"), "item_blocks")
    reach = {r["block"]: (r["length"], r["bias"]) for r in placed.groupBy("block").agg(F.max(_length("vec")).alias("length"), F.max("bias").alias("bias")).collect()}  # n_blocks rows
    first, *others = sorted(reach)
    users = materialize(users, "scored_users")
    where = lookup_join(seen, placed.select("item_id", "block"), "item_id", "user_id", "inner")
    where = materialize(where.join(users.select("user_id"), "user_id", "left_semi"), "seen_in_blocks")
    ahead = materialize(meet(placed.where(F.col("block") == first), users.select("*", F.lit(first).alias("block"), no_floor), where.where(F.col("block") == first), n_blocks), "first_block")
    kth = ahead.where(F.col("rank") == k).select("user_id", F.col("score").alias("kth"))
    reached = [F.when(F.coalesce(F.col("kth") <= (F.col("length") * reach[b][0] + reach[b][1]) * 1.0 + (F.col("length") * reach[b][0] + abs(reach[b][1]) + 1.0) * ROUNDING, F.lit(True)), b) for b in others]
    open_to = F.filter(F.array(*reached), lambda b: b.isNotNull()) if others else F.array().cast("array<int>")
    asked = users.join(kth, "user_id", "left").withColumn("length", _length("vec")).select("user_id", "vec", F.col("kth").alias("floor"), F.explode(open_to).alias("block"))
    rest = meet(placed.where(F.col("block") != first), asked, where.where(F.col("block") != first), n_blocks)
    best = top_k_per_group(ahead.unionByName(rest).drop("rank"), "user_id", [F.col("score").desc(), F.col("item_id").asc()], k)
    return best.select("user_id", "rank", "item_id", "score")


def similar_items(items: DataFrame, k: int) -> DataFrame:
    """(item_id, rank, similar_id, score): nearest other items by inner product."""
    asking = items.select(F.col("item_id").alias("user_id"), "vec")
    itself = items.select(F.col("item_id").alias("user_id"), "item_id")
    best = score_top_k(asking, items.select("item_id", "vec"), k, seen=itself)
    return best.select(F.col("user_id").alias("item_id"), "rank", F.col("item_id").alias("similar_id"), "score")


def recommend_from_vectors(users: DataFrame, user_vectors: DataFrame, items: DataFrame, history: DataFrame | None, k: int = 20) -> DataFrame:
    """Top k for the given users; users without a vector get no rows.

    ``history=None`` leaves seen items in, as plain vector search does.
    """
    known = user_vectors.join(users.select("user_id").distinct(), "user_id", "left_semi")
    return score_top_k(known, items, k, history)


def mean_item_vectors(pairs: DataFrame, items: DataFrame, dim: int) -> DataFrame:
    """Unit-length mean of the vectors of a user's items; stands in for a trained user side."""
    items = items.select("item_id", "vec")
    joined = lookup_join(pairs.select("user_id", "item_id"), items, "item_id", "user_id", "inner")
    if not fits_broadcast(items):  # rows come by item, and a vector is smaller than the sums of one
        joined = joined.select("user_id", "vec").repartition("user_id")
    return joined.groupBy("user_id").agg(mean_vector(F.col("vec"), dim).alias("vec")).select("user_id", l2_normalize(F.col("vec")).alias("vec"))
