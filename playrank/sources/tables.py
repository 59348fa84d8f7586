"""Saved splits, summaries, results and the serving export."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playrank.operators.relational import global_rank
from playrank.sources.cleaning import INTERACTION_COLUMNS

SPLITS = ("train", "validation", "test")
PUBLISHED = "published"  # folder of an export with one entry per completed batch


def save_splits(labelled: DataFrame, catalog: DataFrame, path: str) -> None:
    """Write one folder per split plus ``items``.

    Rows are clustered by user, the key almost every later step groups by; each file then
    covers few users and compresses well.
    """
    rows = labelled.select(*INTERACTION_COLUMNS, "split")
    rows.repartition("split", "user_id").sortWithinPartitions("split", "user_id", "item_id").write.mode(
        "overwrite"
    ).partitionBy("split").parquet(os.path.join(path, "interactions"))
    catalog.write.mode("overwrite").parquet(os.path.join(path, "items"))


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(os.path.join(path, "interactions"))


def read_split(spark: SparkSession, path: str, split: str, columns: Sequence[str] = INTERACTION_COLUMNS) -> DataFrame:
    """One split, pruned to ``columns``; only its own folder is listed and read."""
    if split not in SPLITS:
        raise ValueError(f"unknown split {split!r}")
    return read_splits(spark, path).where(F.col("split") == split).select(*columns)


def read_tagged(spark: SparkSession, path: str, split: str, columns: Sequence[str]) -> DataFrame:
    return read_split(spark, path, split, columns).withColumn("split", F.lit(split))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(os.path.join(path, "items"))


def split_row_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows per split. No data column is read: the counts come from the file footers."""
    return read_splits(spark, path).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


def write_summary(summary: DataFrame, path: str) -> None:
    """Small report tables as one CSV and one JSON-lines file each."""
    single = summary.coalesce(1)
    single.write.mode("overwrite").option("header", True).csv(os.path.join(path, "csv"))
    single.write.mode("overwrite").json(os.path.join(path, "json"))


def read_results(spark: SparkSession, path: str, metrics: Sequence[str]) -> DataFrame:
    """A results file {split: [{model, metric...}]} as rows (split, model, metrics)."""
    entry = T.StructType(
        [T.StructField("model", T.StringType()), T.StructField("users", T.LongType())]
        + [T.StructField(m, T.DoubleType()) for m in metrics]
    )
    schema = T.StructType([T.StructField(s, T.ArrayType(entry)) for s in SPLITS])
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    parts = [raw.select(F.lit(s).alias("split"), F.explode(s).alias("r")).select("split", "r.*") for s in SPLITS]
    return reduce(DataFrame.unionByName, parts)


def insert_missing(new: DataFrame, existing: DataFrame | None, key: str) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet, one per key."""
    unique = new.dropDuplicates([key])
    return unique if existing is None else unique.join(existing.select(key), key, "left_anti")


def serving_tables(train: DataFrame, test: DataFrame, catalog: DataFrame) -> dict[str, DataFrame]:
    """Relational serving schema. Users cover both splits, so no interaction lacks its user.

    A user is created with the first event; interaction ids are given when they are stored.
    """
    times = train.select("user_id", "event_time").unionByName(test.select("user_id", "event_time"))
    users = times.groupBy("user_id").agg(F.min("event_time").alias("created_at"))
    items = catalog.select("item_id", "title", "category", "image_url")
    interactions = test.select(
        "user_id",
        "item_id",
        F.lit("play").alias("event_type"),
        F.col("hours").alias("playtime_forever"),
        "event_time",
    )
    return {"users": users, "items": items, "interactions": interactions}


def _file_system(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def published_batches(spark: SparkSession, path: str) -> list[str]:
    """Batches of an export that were completed: one small file each, in name order."""
    fs, place = _file_system(spark, os.path.join(path, PUBLISHED))
    return sorted(f.getPath().getName() for f in fs.listStatus(place)) if fs.exists(place) else []


def read_export(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """A table of the export, from published batches alone; None before the first."""
    folders = [os.path.join(path, name, b) for b in published_batches(spark, path)]
    return spark.read.parquet(*folders) if folders else None


def export_serving(tables: dict[str, DataFrame], path: str, batch: str | None = None) -> None:
    """Insert users and items that are absent, append the interactions with ids that go on from the last one.

    All parts are written under the name of the batch and seen by no reader until one file publishes them together. A
    batch that was published adds nothing when it is sent again; one that broke off leaves nothing that is read, and its
    parts are deleted, at the latest when it is sent again. Batches are to be sent one after the other.
    """
    spark = tables["users"].sparkSession
    batch = batch or uuid.uuid4().hex
    if not batch.replace("-", "").replace("_", "").isalnum() or batch.startswith("_"):
        raise ValueError(f"a batch is named by letters, digits, - and _, not {batch!r}")
    if batch in published_batches(spark, path):
        return
    folder = lambda name: os.path.join(path, name, batch)
    try:
        for name, key in (("users", "user_id"), ("items", "item_id")):
            insert_missing(tables[name], read_export(spark, path, name), key).write.mode("overwrite").parquet(folder(name))
        before = read_export(spark, path, "interactions")
        last = before.agg(F.max("id")).first()[0] or 0 if before is not None else 0
        numbered = global_rank(tables["interactions"], [F.col(c) for c in ("event_time", "user_id", "item_id")], "id")
        rows = numbered.select((F.col("id") + F.lit(last)).alias("id"), *tables["interactions"].columns)
        rows.write.mode("overwrite").parquet(folder("interactions"))
        fs, staged = _file_system(spark, os.path.join(path, "staged", batch))
        fs.create(staged, True).close()
        _, entry = _file_system(spark, os.path.join(path, PUBLISHED, batch))
        fs.mkdirs(entry.getParent())
        if not fs.rename(staged, entry):
            raise RuntimeError(f"could not publish batch {batch!r}")
    except BaseException:
        for name in ("users", "items", "interactions"):
            fs, place = _file_system(spark, folder(name))
            fs.delete(place, True)
        raise
