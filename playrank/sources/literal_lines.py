"""Gzipped text with one Python-literal dict per line, read as a Spark job."""

from __future__ import annotations

import ast
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playrank.operators.relational import lookup_join
from playrank.session import materialize

REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("username", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("hours", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("early_access", T.BooleanType()),
        T.StructField("products", T.StringType()),
        T.StructField("found_funny", T.StringType()),
        T.StructField("compensation", T.StringType()),
    ]
)

GAME_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("app_name", T.StringType()),
        T.StructField("genres", T.ArrayType(T.StringType())),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("release_date", T.StringType()),
        T.StructField("developer", T.StringType()),
        T.StructField("publisher", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("early_access", T.BooleanType()),
        T.StructField("url", T.StringType()),
    ]
)


PLACE = ["_source", "_block", "_line"]


def _convert(value: object, kind: T.DataType) -> object:
    if isinstance(kind, T.ArrayType):
        return [str(v) for v in value] if isinstance(value, list) else None
    if isinstance(kind, T.BooleanType):
        return bool(value)
    return None if value is None else str(value)


def _to_json(line: str, fields: list[tuple[str, T.DataType]]) -> str | None:
    """A literal dict line as a JSON object with the declared fields, or None if malformed."""
    try:
        record = ast.literal_eval(line.strip())
        return json.dumps({name: _convert(record.get(name), kind) for name, kind in fields})
    except (SyntaxError, ValueError, AttributeError, TypeError, RecursionError, MemoryError):
        return None


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, _source, _block, _line): every line with its number in its file, counted from one.

    Spark reads a file in splits, each of which only knows its own lines. Lines are counted per split, and the counts of
    a file's earlier splits, one small row each, are added to a line's place in its own.
    """
    lines = spark.read.text(path).select(
        F.make_valid_utf8("value").alias("value"),
        F.col("_metadata.file_path").alias("_source"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    splits = lines.groupBy("_source", "_block").agg(F.min("_line").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy("_source").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    name = F.concat_ws("@", "_block", "_source")
    offset = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) + 1 - F.col("_first")
    offsets = materialize(splits.select(name.alias("_split"), offset.alias("_offset")), "line_offsets")
    placed = lookup_join(lines.withColumn("_split", name), offsets, "_split", "_line", "inner")
    return placed.select("value", "_source", "_block", (F.col("_line") + F.col("_offset")).alias("_line"))


def read_literal_lines(spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """Parse literal lines to ``schema`` plus ``_source``, ``_block`` and ``_line``, the line's number in its file.

    Lines are checked in Python and typed by ``from_json``. FAILFAST raises on a malformed
    line, with its file, its number and the line itself; PERMISSIVE keeps it in
    ``_corrupt_record``. Blank lines are counted but skipped and undecodable bytes replaced. ``_block`` is
    where the line's split begins in its file; how Spark packs splits into tasks does not matter. A
    gzip file is a single split: where there are fewer splits than cores, the lines are spread
    right after they are numbered.
    """
    if mode not in ("FAILFAST", "PERMISSIVE"):
        raise ValueError(f"unknown mode {mode!r}")
    fields = [(f.name, f.dataType) for f in schema.fields]
    lines = numbered_lines(spark, path).where(F.length(F.trim("value")) > 0)
    if lines.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
        lines = lines.repartition(F.xxhash64("_source", "_line"))

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(_json=[_to_json(v, fields) for v in batch["value"]])

    parsed = lines.mapInPandas(parse, "value string, _source string, _block bigint, _line bigint, _json string")
    bad = F.col("_json").isNull()
    columns = [F.from_json("_json", schema).alias("_row"), *PLACE]
    if mode == "FAILFAST":
        message = F.concat(F.lit("could not parse "), F.col("_source"), F.lit(" line "), F.col("_line"), F.lit(": "), F.col("value"))
        checked = parsed.withColumn("_json", F.when(bad, F.raise_error(message).cast("string")).otherwise(F.col("_json")))
        return checked.select(*columns).select("_row.*", *PLACE)
    corrupt = F.when(bad, F.col("value")).alias("_corrupt_record")
    return parsed.select(*columns, corrupt).select("_row.*", *PLACE, "_corrupt_record")
