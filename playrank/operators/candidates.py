"""Candidate tables between retrieval and ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playrank.operators.interactions import ground_truth
from playrank.operators.relational import SALTS, deal, global_rank, lookup_join, parts_for, shuffled_join, top_k_per_group
from playrank.session import materialize


def label_pairs(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Add ``is_positive``: whether the (user, item) pair is in the ground truth."""
    flagged = truth.select("user_id", "item_id").distinct().withColumn("_hit", F.lit(True))
    return shuffled_join(pairs, flagged, ["user_id", "item_id"], "left").withColumn("is_positive", F.col("_hit").isNotNull()).drop("_hit")


def item_mean_hours(train: DataFrame) -> DataFrame:
    return train.groupBy("item_id").agg(F.avg("hours").alias("item_avg_hours"))


def ranking_candidates(recs: DataFrame, interactions: DataFrame, train: DataFrame, hours_source: str = "train_mean") -> DataFrame:
    """Labelled candidates with the user's latest held-out time and an hours estimate.

    ``hours_source="train_mean"`` uses the item's training mean for every row. ``"heldout"``
    gives interacted rows their held-out hours, which reveals the label to the ranker; it is
    there to reproduce results computed that way. The split is unique per (user, item), so
    label and hours come from one join.
    """
    if hours_source not in ("train_mean", "heldout"):
        raise ValueError(f"unknown hours_source {hours_source!r}")
    known = interactions.groupBy("user_id", "item_id").agg(
        F.min_by("hours", F.struct("event_time", "hours")).alias("_hours"), F.max("is_positive").alias("_positive")
    )
    times = interactions.groupBy("user_id").agg(F.max("event_time").alias("event_time"))
    rows = shuffled_join(recs.select("user_id", "item_id"), known, ["user_id", "item_id"], "left")
    rows = shuffled_join(rows, times, "user_id", "left")
    rows = lookup_join(rows, materialize(item_mean_hours(train), "item_means"), "item_id", "user_id", write=True)
    estimate = F.coalesce("item_avg_hours", F.lit(0.0))
    hours = F.coalesce("_hours", estimate) if hours_source == "heldout" else estimate
    return rows.select(
        "user_id", "item_id", "event_time", hours.alias("hours"), F.coalesce("_positive", F.lit(False)).alias("is_positive")
    )


def retrieval_candidates(recs: DataFrame, interactions: DataFrame, train: DataFrame, hours_source: str = "train_mean") -> DataFrame:
    """Ranking candidates with defaults for the context columns a candidate cannot know.

    A user without held-out rows gets the latest time of the split.
    """
    latest = interactions.agg(F.max("event_time").alias("t")).first()["t"]
    rows = ranking_candidates(recs, interactions, train, hours_source)
    return rows.withColumns(
        {
            "event_time": F.coalesce("event_time", F.lit(latest)),
            "text_length": F.lit(0),
            "early_access_review": F.lit(False),
            "products_owned": F.lit(None).cast("double"),
            "found_funny": F.lit(0.0),
            "received_for_free": F.lit(False),
        }
    )


def popularity_candidates(split: DataFrame, train: DataFrame, users: DataFrame, k: int = 100) -> DataFrame:
    """Every positive of the user plus the k most popular items as negatives.

    The positives are put in by hand, so this is training input and never a retrieval result.
    """
    rows = shuffled_join(split, users.select("user_id").distinct(), "user_id", "left_semi")
    times = rows.groupBy("user_id").agg(F.max("event_time").alias("event_time"))
    positives = shuffled_join(rows.where("is_positive").select("user_id", "item_id", "hours"), times, "user_id")
    positives = positives.select("user_id", "item_id", "hours", "event_time", F.lit(True).alias("is_positive"))
    counts = train.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    head = counts.orderBy(F.col("n").desc(), F.col("item_id").asc()).limit(k)
    ids = [F.lit(r["item_id"]) for r in head.collect()]  # k rows
    offered = times.select("user_id", "event_time", F.explode(F.array(*ids)).alias("item_id"))
    negatives = shuffled_join(offered, ground_truth(rows), ["user_id", "item_id"], "left_anti").select(
        "user_id", "item_id", F.lit(0.0).alias("hours"), "event_time", F.lit(False).alias("is_positive")
    )
    return positives.unionByName(negatives)


def split_groups(rows: DataFrame, share: float = 0.8, key: str = "user_id") -> DataFrame:
    """Add ``part``: ``fit`` for the first share of query groups in key order, else ``valid``."""
    ranked = global_rank(rows.select(key).distinct(), [F.col(key).asc()], "_rn")
    total = ranked.count()
    part = F.when(F.col("_rn") <= F.lit(int(total * share)), F.lit("fit")).otherwise(F.lit("valid"))
    return shuffled_join(rows, ranked.select(key, part.alias("part")), key)


def most_played(split: DataFrame, k: int, places: int | None = None, rows: int | None = None) -> DataFrame:
    """Items of each user by total hours; totals that are equal to ``places`` digits count as equal.

    Rows are summed and ranked in tasks of limited size whatever the table's: beyond what the session's partitions hold
    they are dealt by user and a salt of the item, each task keeps a user's first ``k`` items there, and only these meet
    by user. ``rows`` bounds the rows of the split; they are counted if it is not given.
    """
    total, order = F.sum("hours"), [F.col("total_hours").desc(), F.col("item_id").asc()]
    total = (total if places is None else F.round(total, places)).alias("total_hours")
    parts = parts_for(split.sparkSession, split.count() if rows is None else rows)
    if not parts:
        return top_k_per_group(split.groupBy("user_id", "item_id").agg(total), "user_id", order, k)
    salted = split.select("user_id", "item_id", "hours", F.pmod(F.xxhash64("item_id"), F.lit(SALTS)).alias("_salt"))
    totals = deal(salted, parts, "user_id", "_salt").groupBy("user_id", "_salt", "item_id").agg(total)
    first = top_k_per_group(totals, ["user_id", "_salt"], order, k).drop("_salt", "rank")
    return top_k_per_group(deal(first, parts, "user_id"), "user_id", order, k)


def group_share(rows: DataFrame, keys: list[str], within: str) -> DataFrame:
    """Count per key combination and its share of the ``within`` total."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(within)))
