"""A training-data pipeline over ``documents``: filter, delete repeated lines, keep one of each group of near copies, mix, encode.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of ``documents``; ``n_chars`` follows the text. When a stage begins, the
working tables of the stage before are deleted, since its result has been written; from then on texts go to the Python
workers in small batches, as the session's setting says.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playrank.llm.line_dedup import dedup_lines
from playrank.llm.mixing import mixed_documents
from playrank.llm.pieces import encode_digests
from playrank.llm.quality_rules import filter_quality
from playrank.llm.queries import public_model
from playrank.llm.runs import split_by_keys
from playrank.llm.set_join import jaccard_components
from playrank.session import drop_tables, materialize, new_path, recording

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
BATCH_ROWS = 1000  # texts in one Arrow batch: a batch stands in memory several times, in the JVM and in the Python worker
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_working: dict[str, list[str]] = {}  # by application, the tables that its last stage wrote


def _stage(work: Stage) -> Stage:
    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        session = docs.sparkSession
        session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        drop_tables(session, _working.pop(session.sparkContext.applicationId, []), keep=docs)
        with recording() as written:
            result = work(session, docs, sf_dir)
        _working[session.sparkContext.applicationId] = written
        return result

    return run_stage


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base limits or a learned rule reject go."""
    labels = spark.read.parquet(os.path.join(sf_dir, "labels.parquet"))
    return filter_quality(docs, labels).select(*COLUMNS)


@_stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go; so does a document of which no word is left."""
    cut = dedup_lines(docs, 50)
    emptied = F.col("_deleted").isNotNull() & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return _counted(cut.where(~F.coalesce(emptied, F.lit(False))))


@_stage
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row stays of each group linked by 5-word shingles at 0.8 or more: that with the smallest id, null last.

    Rows that repeat an id or have none are copies like all others; of rows with equal id and text one stays. Rows
    without words stay. Only rows that may have to go are shuffled.
    """
    rows = docs.select(F.xxhash64(F.col("doc_id").cast("bigint"), "text").alias("key"), *COLUMNS)
    groups = jaccard_components(rows.select(F.col("key").alias("doc_id"), "text"), 5, 80).where("n_shingles > 0")
    groups = groups.groupBy(F.col("doc_id").alias("key")).agg(F.first("component_id").alias("component_id"), F.count("*").alias("copies"))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.xxhash64("text").alias("text"))
    placed = rows.groupBy("key").agg(F.min(place).alias("place")).join(groups, "key")
    first = placed.groupBy("component_id").agg(F.min(F.struct("place", "key")).alias("first")).select(F.col("first.key").alias("key"), F.lit(True).alias("stays"))
    # Of a key: whether its rows go, or one of several stays.
    judged = groups.select("key", "copies").join(first, "key", "left").where("stays IS NULL OR copies > 1").select("key", F.coalesce("stays", F.lit(False)).alias("stays"))
    judged = materialize(judged, "judged")
    asked, others = split_by_keys(rows, "key", judged)
    unjudged = asked.join(judged, "key", "left_anti")
    several = asked.join(judged.where("stays").select("key"), "key")
    nth = F.row_number().over(W.partitionBy("key").orderBy("lang", "source", "n_chars"))
    one = several.withColumn("nth", nth).where("nth = 1").select(*rows.columns)
    return others.unionByName(unjudged).unionByName(one).select(*COLUMNS)


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a whole document comes as often as the mix draws it, in the order of the shards."""
    return _counted(mixed_documents(docs, in_order=True))


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text."""
    return encode_digests(docs, public_model(), with_ids=True)


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near_copies), ("mixing sources to target weights", mix), ("SentencePiece encoding", encode)]

#: Learned rules and encoding are beyond SQL; the stages are tested one by one against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        path = new_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
