"""Phrase collocations from a weighted de Bruijn graph of word runs, exact.

Texts are cut into pieces at punctuation, and every word position gives one row: the longest run of words that begins
there, at most ``longest`` words. Rows of that length are the edges of the graph; they lead from the run without its
last word to the run without its first. Shorter rows are ends: nothing goes on behind them inside their piece. Edges and
ends are added up once; that is the only large shuffle. All shorter counts are then derived from them: a run occurs as
often as flow leaves its node, plus as often as a piece ends with it.

A piece is also cut between two words that stand side by side fewer than ``min_count`` times, since no phrase spans such a
place. Those places are known from exact counts of pair hashes, handed to the tasks as a bitmap of at most
``2**MOST_BITS`` bits. A hash that meets a frequent one leaves an edge in that is not needed, and never takes one away.

Nodes with one edge in and one edge out that carry all of the node's flow lie on unary paths. They are compacted: the
node is no phrase of its own, and ``phrase_paths`` gives each path as one long phrase.

Inside a task, runs of a chunk of text are told apart by 64-bit hashes; between tasks by their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playrank.llm.runs import ROW, keyed_rows
from playrank.llm.text import LOWER, SPACE, chunks, mix, signed, span_hashes, words
from playrank.session import materialize

CHUNK = 1 << 20  # bytes of text looked at together
LEAST_BITS, MOST_BITS = 16, 28
BITS_PER_PAIR = 16
BLOCK = 32_768  # bits in one value of Spark's bitmap aggregate
STEP = np.uint64(0xD6E8FEB86659FD93)

# What ends a piece, and what stands between words.
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
BETWEEN = ENDS | SPACE


@dataclass(frozen=True)
class Phrases:
    """What mining gives: written tables."""

    words: DataFrame  # (lang, n): all word occurrences
    runs: DataFrame  # (lang, words, phrase, f, covered, unary): runs of 1 to ``longest`` words that occur often enough
    longest: int
    cover: int


class _Chunk:
    """Words of some texts with their pieces, hashes and languages."""

    def __init__(self, rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> None:
        self.data = data
        self.starts, self.ends, first = words(data, offsets, BETWEEN)
        self.langs = rows.column("lang").to_pylist()
        seeds = np.array([xxhash.xxh64_intdigest(x.encode()) for x in self.langs], np.uint64)
        self.text = np.repeat(np.arange(len(self.langs)), np.diff(first))
        self.hash = span_hashes(data, self.starts, self.ends, lower=True)
        piece = np.searchsorted(np.flatnonzero(ENDS[data]), self.starts)
        self.joined = (piece[1:] == piece[:-1]) & (self.text[1:] == self.text[:-1])
        self.one = mix(self.hash ^ seeds[self.text])

    def longer(self, run: np.ndarray, n: int) -> np.ndarray:
        """Hashes of runs of ``n`` words from those of ``n - 1``; one place shorter."""
        return mix(run[: len(self.hash) - n + 1] * STEP + self.hash[n - 1 :])


def _langs(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    return rows.where("text <> ''")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Chunk]:
    for batch in batches:
        for rows, data, offsets in chunks(batch, "text", CHUNK):
            chunk = _Chunk(rows, data, offsets)
            if len(chunk.hash):
                yield chunk


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in _chunks(batches):
        pair, count = np.unique(chunk.longer(chunk.one, 2)[chunk.joined], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(signed(pair)), pa.array(count)], ["pair", "c"])


def frequent_pairs(docs: DataFrame, min_count: int) -> tuple[np.ndarray, int]:
    """Bitmap of the hashes of word pairs that occur ``min_count`` times, and its number of address bits."""
    pairs = _langs(docs).mapInArrow(_pairs, "pair bigint, c bigint").groupBy("pair").agg(F.sum("c").alias("c"))
    found = materialize(pairs.where(F.col("c") >= min_count).select("pair"), "pairs")
    bits = min(MOST_BITS, max(LEAST_BITS, (found.count() * BITS_PER_PAIR).bit_length()))
    place = F.shiftrightunsigned("pair", 64 - bits) + 1  # Spark's bitmap positions count from one
    blocks = found.groupBy(F.bitmap_bucket_number(place).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("b"))
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    for r in blocks.toLocalIterator():  # 2**(MOST_BITS - 3) bytes at most
        bitmap[(r["k"] - 1) * BLOCK // 8 : r["k"] * BLOCK // 8] = np.frombuffer(r["b"], np.uint8)
    return bitmap, bits


def _emit(longest: int, bitmap, bits: int):
    """Rows (lang, words, phrase, c): the longest run at every position, added up inside a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bitmap.value
        for chunk in _chunks(batches):
            n = len(chunk.hash)
            place = chunk.longer(chunk.one, 2) >> np.uint64(64 - bits)
            goes_on = np.append(chunk.joined & ((table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1).astype(bool), False)
            length, value, run_hash, open_ = np.ones(n, np.int64), chunk.one.copy(), chunk.one, np.ones(n, bool)
            for k in range(2, min(longest, n) + 1):
                run_hash = chunk.longer(run_hash, k)
                open_ = open_[: n - k + 1] & goes_on[k - 2 : n - 1]
                at = np.flatnonzero(open_)
                length[at], value[at] = k, run_hash[at]
            _, first, count = np.unique(value, return_index=True, return_counts=True)
            # One space behind each word makes a run one slice of bytes.
            keep = ~BETWEEN[chunk.data]
            clean = LOWER[chunk.data].astype(np.uint8)
            behind = chunk.ends[chunk.ends < len(clean)]
            behind = behind[BETWEEN[chunk.data[behind]]]  # not the next text's first word
            keep[behind], clean[behind] = True, 0x20
            clean = clean[keep]
            moved = np.cumsum(keep) - keep
            a, b = moved[chunk.starts[first]], moved[chunk.ends[first + length[first] - 1] - 1] + 1
            to = np.concatenate([[0], np.cumsum(b - a)])
            raw = clean[np.repeat(a - to[:-1], b - a) + np.arange(to[-1])]
            phrase = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(to.astype(np.int64)), pa.py_buffer(raw)).cast(pa.string())
            lang = pa.array(chunk.langs, pa.string()).take(pa.array(chunk.text[first]))
            yield pa.RecordBatch.from_arrays([lang, pa.array(length[first].astype(np.int32)), phrase, pa.array(count)], ["lang", "words", "phrase", "c"])

    return run


def _first_words(k: Column | int) -> Column:
    return F.call_function("substring_index", F.col("phrase"), F.lit(" "), k if isinstance(k, Column) else F.lit(k))


def mine_phrases(docs: DataFrame, longest: int = 4, min_count: int = 30, cover: int = 80) -> Phrases:
    """All runs of up to ``longest`` words that occur ``min_count`` times in the texts of a language.

    ``docs`` holds lang and text; A-Z is lower-cased. A null lang is ``und``, also beside rows that say so; null, empty
    and blank texts give nothing. Repeated rows count each time; overlapping occurrences all count. Other columns are
    left aside, whatever their names. An empty table gives empty tables. Texts of any length are read whole.
    ``covered`` is the greatest count of a frequent run that has one word more and holds this one.
    """
    if longest < 2:
        raise ValueError("a graph needs runs of two words at least")
    bitmap, bits = frequent_pairs(docs, min_count)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    rows = _langs(docs).mapInArrow(_emit(longest, shared, bits), "lang string, words int, phrase string, c bigint")
    edges = materialize(rows.groupBy("lang", "words", "phrase").agg(F.sum("c").alias("c")), "edges")
    total = edges.groupBy("lang").agg(F.sum("c").alias("n"))

    # From level to level: a node has the flow of the edges that leave it and of the ends that stop at it.
    frequent = lambda level, k: level.where((F.col("words") == k) & (F.col("c") >= min_count))
    level, often = edges, frequent(edges, longest)
    for k in range(longest - 1, 0, -1):
        level = level.groupBy("lang", F.least("words", F.lit(k)).alias("words"), _first_words(k).alias("phrase")).agg(F.sum("c").alias("c"))
        level = materialize(level, "nodes")
        often = often.unionByName(frequent(level, k))
    often = often.withColumnRenamed("c", "f")

    sides = F.array(F.struct(F.lit(1).alias("out"), _first_words(F.col("words") - 1).alias("part")), F.struct(F.lit(0).alias("out"), _first_words(1 - F.col("words")).alias("part")))
    around = often.where("words > 1").select("lang", "f", F.explode(sides).alias("side")).select("lang", "f", "side.*")
    around = around.groupBy("lang", F.col("part").alias("phrase")).agg(
        F.max("f").alias("covered"),
        F.sum("out").alias("outs"),
        F.count("*").alias("both"),
        F.min("f").alias("least"),
    )
    # One edge in, one out, and each has the node's whole flow: nothing begins, ends or branches here.
    unary = (F.col("outs") == 1) & (F.col("both") == 2) & (F.col("least") == F.col("f"))
    runs = often.join(around, ["lang", "phrase"], "left").select("lang", "words", "phrase", "f", "covered", F.coalesce(unary, F.lit(False)).alias("unary"))
    return Phrases(total, materialize(runs, "phrases"), longest, cover)


def score_phrases(mined: Phrases, top: int = 2000, scale: int = 2_000_000) -> DataFrame:
    """(lang, rank, phrase, words, a, l, r, n, score): each language's first ``top`` phrases of two words or more.

    A phrase scores ``floor(scale * a / (l + r))`` at its worst cut; of equal ones the first cut counts. Phrases that a
    longer frequent run covers to ``cover`` percent are left out: nodes of unary paths, and those beside an edge that
    holds so much of their flow. (A run two words longer covers no more than one between them.) Ties are broken by a
    descending, then phrase. Products are 38-digit decimals.
    """
    runs = mined.runs
    f = runs.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    covered = F.col("unary") | (F.coalesce("covered", F.lit(0)).cast("decimal(20,0)") * 100 >= F.col("f").cast("decimal(20,0)") * mined.cover)
    left = runs.where((F.col("words") > 1) & ~covered).select("lang", "words", "phrase", F.col("f").alias("a"))
    cuts = left.withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
    cuts = cuts.withColumns({"first": _first_words(F.col("k")), "rest": _first_words(F.col("k") - F.col("words"))})
    cuts = cuts.join(f.withColumnsRenamed({"part": "first", "part_f": "l"}), ["lang", "first"]).join(f.withColumnsRenamed({"part": "rest", "part_f": "r"}), ["lang", "rest"])
    score = F.expr(f"CAST({int(scale)} AS decimal(18,0)) * CAST(a AS decimal(19,0)) div (CAST(l AS decimal(19,0)) + CAST(r AS decimal(19,0)))").cast("bigint")
    worst = cuts.groupBy("lang", "words", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    flat = worst.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = flat.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
    return best.join(mined.words, "lang").select("lang", "rank", "phrase", "words", "a", "l", "r", "n", "score")


def phrase_paths(mined: Phrases) -> DataFrame:
    """(lang, phrase, words, f): every compacted path of the graph as one phrase, ``f`` being the count of all its edges.

    Each edge lies on one path; one that meets no unary node is a path by itself. Pointers to the first edge are doubled
    from round to round, so a path of m edges takes log2(m) rounds. A path's words are no more than a piece has.
    """
    runs, n = mined.runs, mined.longest
    edges = keyed_rows(runs.where(F.col("words") == n).select("lang", "phrase", "f"))
    nodes = runs.where((F.col("words") == n - 1) & F.col("unary")).select("lang", F.col("phrase").alias("node"))
    into = edges.select("lang", F.col(ROW).alias("before"), _first_words(1 - n).alias("node"))
    outof = edges.select("lang", F.col(ROW).alias("id"), _first_words(n - 1).alias("node"))
    links = into.join(nodes, ["lang", "node"]).join(outof, ["lang", "node"]).select("id", "before", F.lit(1).cast("bigint").alias("steps"))
    chain = materialize(links, "chain")
    while True:
        # Where the pointed edge points on, go on with it; every round doubles the steps.
        on = chain.select(F.col("id").alias("before"), F.col("before").alias("further"), F.col("steps").alias("more"))
        joined = chain.join(on, "before", "left")
        moved = materialize(joined.select("id", F.coalesce("further", "before").alias("before"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("further").isNotNull().alias("moving")), "chain")
        chain = moved.drop("moving")
        if moved.where("moving").isEmpty():
            break
    placed = edges.join(chain.withColumnRenamed("id", ROW), ROW, "left")
    placed = placed.select("lang", "f", F.coalesce("before", ROW).alias("path"), F.coalesce("steps", F.lit(0)).alias("steps"), "phrase")
    part = F.when(F.col("steps") == 0, F.col("phrase")).otherwise(_first_words(-1))
    paths = placed.groupBy("lang", "path", "f").agg(F.sort_array(F.collect_list(F.struct("steps", part.alias("part")))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["part"]), " ")
    return paths.select("lang", text.alias("phrase"), (F.size("parts") + n - 1).alias("words"), "f")
