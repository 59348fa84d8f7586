"""Delete later copies of repeated runs of lines, found by a suffix array over line ids.

Each document is a sequence of line ids (lines with a word; blank lines carry no id). Prefix doubling names the suffixes:
in round k a position's rank comes from the pair (rank of its first 2^(k-1) lines, rank of the next 2^(k-1)). Pairs are
numbered in sorted order by a range sort, so ranks are the suffix order to that depth; positions whose rank is held by
nobody else have no repeat of that depth and leave the array. The doubling ends where the depth covers the run length
asked for.

Suffixes that agree over a run are one interval of longest common prefixes. A run is the shortest one from a line
onwards, and the shortest one back from a line, with ``min_words`` words; every maximal repeated run of at least that many words
is exactly the union of such runs, so together they reveal it whole. In each interval the first place (doc_id, then
position) keeps its lines and all later places lose theirs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playrank.llm.runs import ROW, join_by_share, keyed_rows, split_by_keys
from playrank.llm.text import chunks, lines, signed, span_hashes, words
from playrank.session import materialize


def _line_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, d, pos, line, r, words): every line with a word; ``line`` is its number among all lines of its text."""
    for batch in batches:
        for rows, data, offsets in chunks(batch, "text"):
            starts, ends, first = lines(data, offsets)
            begun, _, _ = words(data, offsets)
            count = np.searchsorted(begun, ends) - np.searchsorted(begun, starts)
            doc = np.repeat(np.arange(rows.num_rows), np.diff(first))
            number = np.arange(len(starts)) - first[doc]
            kept = np.flatnonzero(count > 0)
            doc = doc[kept]
            seen = np.searchsorted(doc, doc)
            take = pa.array(doc)
            arrays = [np.arange(len(doc)) - seen, number[kept], signed(span_hashes(data, starts[kept], ends[kept])), count[kept]]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").take(take), rows.column("d").take(take), *[pa.array(a.astype(np.int64)) for a in arrays]],
                ["doc_id", "d", "pos", "line", "r", "words"],
            )


def _ranked(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Numbers for the key tuples that occur at least twice, in their sorted order, and how often (``n``)."""
    again = pairs.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return materialize(again.orderBy(*keys).withColumn("rank", F.monotonically_increasing_id()), "ranks")


def repeated_runs(docs: DataFrame, min_words: int) -> DataFrame:
    """(d, from_line, to_line): line ranges to delete, merged, per document key ``d``."""
    found = materialize(docs.select("doc_id", "d", "text").mapInArrow(_line_ids, "doc_id bigint, d bigint, pos bigint, line bigint, r bigint, words bigint"), "lines")
    names = _ranked(found.select("r"), ["r"])
    level = join_by_share(found, names, ["r"], found.count()).select("doc_id", "d", "pos", "line", "words", F.col("rank").alias("r")).distinct()
    level = materialize(level, "level")

    row = W.partitionBy("d").orderBy("pos")
    stretch = level.withColumn("grp", F.col("pos") - F.row_number().over(row))  # neighbouring repeated lines
    inside = W.partitionBy("d", "grp").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    stretch = stretch.withColumn("upto", F.sum("words").over(inside)).withColumn("before", F.col("upto") - F.col("words"))
    onward = W.partitionBy("d", "grp").orderBy("before").rangeBetween(0, min_words - 1)
    back = W.partitionBy("d", "grp").orderBy("upto").rangeBetween(-(min_words - 1), 0)

    def window(frame: W, start: Column) -> DataFrame:
        measured = stretch.withColumns({"len": F.count("*").over(frame), "held": F.sum("words").over(frame), "from_line": F.min("line").over(frame), "to_line": F.max("line").over(frame)})
        return measured.where(F.col("held") >= min_words).select("doc_id", "d", start.alias("start"), "len", "from_line", "to_line")

    windows = window(onward, F.col("pos")).unionByName(window(back, F.col("pos") - F.col("len") + 1)).distinct()
    windows = materialize(windows.withColumn("k", F.floor(F.log2("len")).cast("int")), "windows")
    deepest = windows.agg(F.max("k")).first()[0]
    if deepest is None:
        return windows.select("d", "from_line", "to_line").limit(0)

    ranks = level.select(F.lit(0).alias("k"), "d", "pos", "r")
    current = level.select("d", "pos", "r")
    for k in range(1, deepest + 1):
        ahead = current.select("d", (F.col("pos") - F.lit(1 << (k - 1))).alias("pos"), F.col("r").alias("r2"))
        pairs = materialize(current.withColumnRenamed("r", "r1").join(ahead, ["d", "pos"]), "pairs")
        names = _ranked(pairs, ["r1", "r2"])
        current = materialize(join_by_share(pairs, names, ["r1", "r2"], pairs.count()).select("d", "pos", F.col("rank").alias("r")), "level")
        ranks = ranks.unionByName(current.select(F.lit(k).alias("k"), "d", "pos", "r"))

    # Two overlapping pieces of 2^k lines cover a run; a run with a piece of no rank is not repeated.
    size = F.expr("shiftleft(1L, k)")
    head = ranks.select("k", "d", F.col("pos").alias("start"), F.col("r").alias("head"))
    tail = ranks.select("k", "d", F.col("pos").alias("second"), F.col("r").alias("tail"))
    keyed = windows.withColumn("second", F.col("start") + F.col("len") - size).join(head, ["k", "d", "start"]).join(tail, ["k", "d", "second"])
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "d", "start")
    keyed = materialize(keyed.withColumn("place", place), "intervals")
    first = materialize(keyed.groupBy("len", "head", "tail").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1"), "first")
    later = join_by_share(keyed, first, ["len", "head", "tail"], keyed.count()).where(F.col("place") > F.col("first"))

    # Merged by position, so the blank lines between two deleted lines are inside the range.
    in_order = W.partitionBy("d").orderBy("start", "len")
    reached = F.max(F.col("start") + F.col("len")).over(in_order.rowsBetween(W.unboundedPreceding, -1))
    opened = later.select("d", "start", "len", "from_line", "to_line").distinct().withColumn("opens", F.coalesce((F.col("start") > reached).cast("int"), F.lit(1)))
    merged = opened.withColumn("run", F.sum("opens").over(in_order.rowsBetween(W.unboundedPreceding, 0)))
    return merged.groupBy("d", "run").agg(F.min("from_line").alias("from_line"), F.max("to_line").alias("to_line")).drop("run")


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc, d): each row as one value and its document's key. Rows without an id are documents of their own, told apart by a written key."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    alone = keyed_rows(row.where("doc.doc_id IS NULL")).withColumn("d", F.xxhash64(F.lit("row"), ROW)).drop(ROW)
    return row.where("doc.doc_id IS NOT NULL").withColumn("d", F.xxhash64(F.col("doc.doc_id").cast("bigint"), "doc.text")).unionByName(alone)


def dedup_lines(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """All rows and columns of ``docs``, ``text`` without the deleted lines, plus ``_deleted``: (from_line, to_line) ranges.

    Lines are split at ``\\n`` and equal if all their bytes are. A line is deleted if it lies in a run of at least
    ``min_words`` words that occurs earlier, in another document or further up in its own; blank lines between deleted
    ones go with them. Null texts stay null, empty and blank texts stay as they are. Rows with equal doc_id and text
    are the same document and get the same result; rows with a null doc_id are documents of their own and come last in
    the order. An empty table gives no rows. All columns of the input are kept, whatever their names, but for one called
    ``_deleted``, which is replaced. Only texts that lose lines are shuffled.
    """
    if min_words < 1:
        raise ValueError("min_words must be positive")
    docs = docs.drop("_deleted")
    keyed = _keyed(docs)
    plain = keyed.select(F.col("doc.doc_id").cast("bigint").alias("doc_id"), "d", F.col("doc.text").alias("text")).where("text IS NOT NULL")
    runs = repeated_runs(plain, min_words)
    ranges = runs.groupBy("d").agg(F.sort_array(F.collect_list(F.struct("from_line", "to_line"))).alias("cut"))
    ranges = materialize(ranges, "ranges")
    touched, whole = split_by_keys(keyed, "d", ranges.select("d"))
    joined = touched.join(ranges, "d", "left").select("doc", "cut").unionByName(whole.select("doc", F.lit(None).cast(ranges.schema["cut"].dataType).alias("cut")))
    left = F.filter(F.split("doc.text", "\n", -1), lambda _, i: ~F.exists("cut", lambda r: (r["from_line"] <= i) & (i <= r["to_line"])))
    text = F.when(F.col("cut").isNull(), F.col("doc.text")).otherwise(F.array_join(left, "\n"))
    kept = [(text if c == "text" else F.col("doc").getField(c)).alias(c) for c in docs.columns]
    return joined.select(*kept, F.col("cut").alias("_deleted"))
