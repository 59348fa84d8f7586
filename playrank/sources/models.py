"""Model artefacts as tables: factor tables, rankings, vocabularies and weights."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def save_table(rows: DataFrame, path: str, name: str) -> None:
    rows.write.mode("overwrite").parquet(os.path.join(path, name))


def load_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(path, name))


def save_vocabulary(vocabulary: DataFrame, path: str) -> None:
    """(place, value) rows, which encoding a later split must keep."""
    save_table(vocabulary.select("place", "value"), path, "vocabulary")


def load_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    return load_table(spark, path, "vocabulary")
