"""History, ground truth and aggregate views of the interaction table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playrank.operators.relational import global_rank


def history(*splits: DataFrame) -> DataFrame:
    """Distinct (user_id, item_id) seen in any of the splits."""
    pairs = [s.select("user_id", "item_id") for s in splits]
    return reduce(DataFrame.unionByName, pairs).distinct()


def ground_truth(split: DataFrame) -> DataFrame:
    """Distinct positive (user_id, item_id) pairs of a split."""
    return split.where("is_positive").select("user_id", "item_id").distinct()


def item_sets(pairs: DataFrame) -> DataFrame:
    """One sorted array of items per user. For display; the operators use the long form."""
    return pairs.groupBy("user_id").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


def positive_rate() -> Column:
    return F.avg(F.col("is_positive").cast("int"))


def item_index(items: DataFrame) -> DataFrame:
    """Distinct items with dense positions 0..n-1 in id order."""
    ranked = global_rank(items.select("item_id").distinct(), [F.col("item_id").asc()], "idx")
    return ranked.withColumn("idx", F.col("idx") - 1)


def group_sizes(rows: DataFrame, key: str = "user_id") -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("group_size"))


def group_layout(rows: DataFrame, key: str = "user_id", within: str = "item_id") -> DataFrame:
    """Rows of one query group in one partition, contiguous and ordered."""
    return rows.repartition(key).sortWithinPartitions(key, within)
