"""Chronological splits and the most-recent cap, exact at any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playrank.operators.relational import cut_by_order

TEST_FRACTION = 0.2
VALIDATION_FRACTION_OF_TRAIN = 0.1


def _chronological() -> list[Column]:
    return [F.col("event_time"), F.col("user_id"), F.col("item_id")]


def _day() -> Column:
    return F.to_date("event_time")


def most_recent(interactions: DataFrame, max_rows: int) -> DataFrame:
    """The latest ``max_rows`` rows; all rows if there are fewer."""
    cut = lambda total: F.greatest(total - F.lit(max_rows), F.lit(0))
    return cut_by_order(interactions, _day(), _chronological(), [cut]).where("segment = 1").drop("segment")


def time_based_split(
    interactions: DataFrame,
    validation_fraction: float = VALIDATION_FRACTION_OF_TRAIN,
    test_fraction: float = TEST_FRACTION,
) -> DataFrame:
    """Label rows train, validation or test, oldest first, by exact row counts."""

    def test_start(total: Column) -> Column:
        return F.floor(total.cast("double") * F.lit(1 - test_fraction))

    def validation_start(total: Column) -> Column:
        return F.floor(test_start(total).cast("double") * F.lit(1 - validation_fraction))

    marked = cut_by_order(interactions, _day(), _chronological(), [validation_start, test_start])
    split = F.element_at(F.array(F.lit("train"), F.lit("validation"), F.lit("test")), F.col("segment") + 1)
    return marked.withColumn("split", split).drop("segment")


def split_boundaries(labelled: DataFrame) -> DataFrame:
    """Rows, time range and positive rate of every split."""
    return labelled.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("event_time").alias("start_time"),
        F.max("event_time").alias("end_time"),
        F.avg(F.col("is_positive").cast("int")).alias("positive_rate"),
    )
