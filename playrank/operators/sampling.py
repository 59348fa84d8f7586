"""Seeded samples that do not depend on partitioning or engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playrank.functions.draws import hash_key, hash_number
from playrank.operators.baselines import draw_unseen, nth_unseen, seen_positions
from playrank.operators.relational import cut_by_order, lookup_join, top_k_per_group
from playrank.session import materialize

HASH_PREFIX = 4  # hex digits: 65,536 buckets of near-equal size


def sample_rows(df: DataFrame, keys: list[str], n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all if fewer), those with the smallest hash of their key."""
    keyed = df.withColumn("_h", hash_key(seed, *[F.col(k) for k in keys]))
    order: list[Column] = [F.col("_h"), *[F.col(k) for k in keys]]
    cut = cut_by_order(keyed, F.substring("_h", 1, HASH_PREFIX), order, [lambda total: F.least(total, F.lit(n))])
    return cut.where("segment = 0").drop("segment", "_h") if n > 0 else df.limit(0)


def sample_training_positives(train: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """All negatives and ``n`` sampled positives."""
    positives = sample_rows(train.where("is_positive"), ["user_id", "item_id"], n, seed)
    return train.where(~F.col("is_positive")).unionByName(positives)


def sample_eligible_users(truth: DataFrame, known: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` users who have ground truth and are known to the model."""
    eligible = truth.select("user_id").distinct().join(known.select("user_id").distinct(), "user_id", "left_semi")
    return sample_rows(materialize(eligible, "eligible"), ["user_id"], n, seed)  # read three times


def sampled_candidates(split: DataFrame, train: DataFrame, index: DataFrame, n_items: int, n_negatives: int = 99, seed: int = 42) -> DataFrame:
    """One positive of the split and ``n_negatives`` unseen items per user.

    The positive is the user's smallest by hash; negatives exclude train items and every
    positive of the user and carry zero hours and the positive's time.
    """
    positives = split.where("is_positive").select("user_id", "item_id", "hours", "event_time")
    chosen = top_k_per_group(
        positives.withColumn("_h", hash_key(seed, F.col("user_id"), F.lit("pos"), F.col("item_id"))),
        "user_id",
        [F.col("_h").asc(), F.col("item_id").asc()],
        1,
    ).select("user_id", "item_id", "hours", "event_time", F.lit(True).alias("is_positive"))
    users = chosen.select("user_id")
    excluded = train.select("user_id", "item_id").unionByName(positives.select("user_id", "item_id"))
    excluded = excluded.join(users, "user_id", "left_semi")
    negatives = draw_unseen(users, excluded, index, n_items, n_negatives, seed)
    times = chosen.select("user_id", "event_time")
    negatives = negatives.join(times, "user_id").select(
        "user_id", "item_id", F.lit(0.0).alias("hours"), "event_time", F.lit(False).alias("is_positive")
    )
    return chosen.unionByName(negatives)


def pair_negatives(positives: DataFrame, index: DataFrame, n_items: int, seed: int = 42) -> DataFrame:
    """(user_id, item_id, negative): one uniform item per positive pair, none of the user's own.

    Users who like the whole catalog have no negative and drop out.
    """
    pairs = positives.select("user_id", "item_id").distinct()
    own = seen_positions(pairs, index, n_items)
    left = own.groupBy("user_id").agg((F.lit(n_items).cast("bigint") - F.count(F.lit(1))).alias("left"))
    number = hash_number(seed, F.col("user_id"), F.col("item_id"))
    queries = pairs.join(left.where("left > 0"), "user_id").select("user_id", "item_id", (number % F.col("left")).alias("nth"))
    names = index.select("idx", F.col("item_id").alias("negative"))
    return lookup_join(nth_unseen(queries, own), names, "idx", "user_id", "inner", write=True).select("user_id", "item_id", "negative")
