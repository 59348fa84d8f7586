"""Batch tables behind the request endpoints."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playrank.operators.candidates import item_mean_hours, most_played
from playrank.operators.relational import lookup_join, top_k_per_group
from playrank.operators.similarity import similar_items
from playrank.session import materialize
from playrank.sources.cleaning import UNKNOWN_CATEGORY

# List sizes of the served tables.
TRENDING_ITEMS = 20
RETRIEVED_ITEMS = 100
MAX_ACTIVE_USERS = 500


def item_cards(rows: DataFrame, catalog: DataFrame, item: str = "item_id", spread: str = "item_id") -> DataFrame:
    """Add title, category and image; items outside the catalog get defaults."""
    cards = catalog.select(F.col("item_id").alias(item), "title", "category", "image_url")
    shown = lookup_join(rows, cards, item, spread, write=True)
    return shown.withColumns(
        {
            "title": F.coalesce("title", F.concat(F.lit("Game "), F.col(item).cast("string"))),
            "category": F.coalesce("category", F.lit(UNKNOWN_CATEGORY)),
            "image_url": F.coalesce("image_url", F.lit("")),
        }
    )


def popular_items(train: DataFrame, n: int) -> DataFrame:
    """Top items by total count with their rank."""
    counts = train.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    head = counts.orderBy(F.col("n").desc(), F.col("item_id").asc()).limit(n)
    return top_k_per_group(head.withColumn("_all", F.lit(1)), "_all", [F.col("n").desc(), F.col("item_id").asc()], n).drop("_all")


def trending(train: DataFrame, catalog: DataFrame, n: int = TRENDING_ITEMS) -> DataFrame:
    return item_cards(popular_items(train, n), catalog)


def similar(items: DataFrame, catalog: DataFrame, k: int = 10) -> DataFrame:
    return item_cards(similar_items(items, k), catalog, "similar_id", "item_id")


def user_history(split: DataFrame, catalog: DataFrame, k: int = 10) -> DataFrame:
    return item_cards(most_played(split, k), catalog, spread="user_id")


def because_you_liked(split: DataFrame, items: DataFrame, catalog: DataFrame, k: int = 10) -> DataFrame:
    """Items similar to each user's most-played held-out item."""
    liked = most_played(split, 1).select("user_id", F.col("item_id").alias("liked_id"))
    near = materialize(similar_items(items, k).withColumnRenamed("item_id", "liked_id"), "similar")
    return item_cards(lookup_join(liked, near, "liked_id", "user_id", "inner", write=True), catalog, "similar_id", "user_id")


def active_users(split: DataFrame, known_users: DataFrame, limit: int = 100) -> DataFrame:
    """Users of the split by whether the model knows them, then by history length."""
    if not 0 < limit <= MAX_ACTIVE_USERS:
        raise ValueError(f"limit must be between 1 and {MAX_ACTIVE_USERS}")
    counts = split.groupBy("user_id").agg(F.count(F.lit(1)).alias("history_count"))
    known = known_users.select("user_id").distinct().withColumn("in_model", F.lit(True))
    flagged = counts.join(known, "user_id", "left").withColumn("in_model", F.coalesce("in_model", F.lit(False)))
    return flagged.orderBy(F.col("in_model").desc(), F.col("history_count").desc(), F.col("user_id").asc()).limit(limit)


def with_popular_fallback(personal: DataFrame, users: DataFrame, known: DataFrame, train: DataFrame, k: int, label: str) -> DataFrame:
    """Personal lists of the users the model knows, the popular list for all others; ``model`` says which.

    Whether a user is known is asked of the model (``known``), never of the lists or of later rows.
    """
    own = personal.where(F.col("rank") <= k).select("user_id", "rank", "item_id", F.lit(label).alias("model"))
    asked = users.select("user_id").distinct()
    cold = asked.join(known.select("user_id").distinct(), "user_id", "left_anti")
    head = [F.struct(F.lit(r["rank"]).alias("rank"), F.lit(r["item_id"]).alias("item_id")) for r in popular_items(train, k).collect()]
    rest = cold.select("user_id", F.explode(F.array(*head)).alias("p")).select(
        "user_id", "p.rank", "p.item_id", F.lit("popularity").alias("model")
    )
    return own.join(asked, "user_id", "left_semi").unionByName(rest)


def serving_candidates(retrieved: DataFrame, train: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Retrieved items as ranking candidates at one moment, by default the last of training.

    Nothing of a later split is read: hours are the item's training mean, and no label is known.
    """
    moment = F.lit(as_of).cast("timestamp_ntz") if as_of is not None else F.lit(train.agg(F.max("event_time")).first()[0])
    rows = lookup_join(retrieved.select("user_id", "item_id"), materialize(item_mean_hours(train), "item_means"), "item_id", "user_id")
    return rows.select("user_id", "item_id", moment.alias("event_time"), F.coalesce("item_avg_hours", F.lit(0.0)).alias("hours"), F.lit(False).alias("is_positive"))
