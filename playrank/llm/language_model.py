"""Language-model scoring: a hashed maximum-entropy model with a class-factored softmax.

P(word | context) = P(class | context) * P(word | class, context). The ``CLASSES * CLASS_WORDS`` most frequent words are in word
classes; every other word is in one of ``RARE`` classes told from its bytes, and inside such a class it has its smoothed
share of that class's counts, so all words together, known or not, sum to one. Features of a context are its last word
(bigram), the word before it (skip), and both hashed (trigram); weights are fixed-size tables.

Training is one pass over all training texts, in rounds. Texts are dealt by hash to parts of ``PART_BYTES``; in a round every
part takes gradient steps on its own from the tables of the round before, at first the exact unigram log counts, and
reports how far each table row moved; rows are averaged over the parts that moved them. Rounds and the parts in each
grow with the square root of the data, and the model follows from the data alone, not from splits or the cluster. The
model has the same size at any input.

Counts cover all training texts. The most frequent words' counts, up to ``HEAD`` of them, are broadcast; the counts of
all others meet their documents in a join on the word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playrank.llm.runs import key_runs, run_bounds
from playrank.llm.text import LOWER, chunks, mix, signed, span_hashes, words
from playrank.session import materialize, new_path

HEAD = 1 << 19  # words whose counts are broadcast: 8 MB at most
CLASSES, CLASS_WORDS = 16, 64
WORDS = CLASSES * CLASS_WORDS
RARE = 64
WIDE = CLASSES + RARE
CONTEXTS = 2048  # hashed contexts of the class tables
PAIRS = 8192  # hashed pairs of words
NEAR = WORDS + RARE + 1  # contexts of the word tables: a frequent word, a rare class, the start
BATCH = 16_384
RATE = 0.3
OFTEN = 24
PART_BYTES = 1 << 24  # text that one task learns from in a round
BLOCKS = 32  # parts in which table changes travel
END = -4611686018427387847  # hash that stands for the end of a text

#: Last byte of a lower-cased word to one of 8 kinds: letter, stop, comma, mark, symbol, digit, bar, other.
_KIND = np.full(256, 7, np.uint8)
_KIND[[*range(97, 123), *range(128, 256)]] = 0
_KIND[46] = 1
_KIND[[44, 58, 59]] = 2
_KIND[[33, 63]] = 3
_KIND[[35, 36, 37, 38, 42]] = 4
_KIND[48:58] = 5
_KIND[124] = 6
_TAIL = np.where((np.arange(256) >= 0x80) & (np.arange(256) < 0xC0), np.arange(256), 0).astype(np.uint8)


def held_out(doc_id: Column) -> Column:
    """Documents that the model does not learn from; a null id is learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and rare class of each token, and the first token of each text: its lower-cased words, then the end."""
    starts, ends, first = words(data, offsets)
    n, docs = len(starts), len(offsets) - 1
    doc = np.repeat(np.arange(docs), np.diff(first))
    hashes = np.empty(n + docs, np.int64)
    kinds = np.zeros(n + docs, np.int64)
    at = np.arange(n) + doc
    hashes[at] = signed(span_hashes(data, starts, ends, lower=True))
    if n:
        spots = np.empty(2 * n, np.int64)
        spots[0::2], spots[1::2] = starts, ends
        padded = np.append(_TAIL[data], np.uint8(0))
        letters = np.maximum.reduceat(padded, spots)[0::2].astype(np.int64)
        kinds[at] = np.where(letters > 0, 1 + letters % 7, 0) * 8 + _KIND[LOWER[data[ends - 1]]]
    begun = first + np.arange(docs + 1)
    hashes[begun[1:] - 1] = END
    return hashes, kinds, begun


def count_tokens(texts: DataFrame) -> DataFrame:
    """(token, kind, c) over the texts that are not held out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> pa.RecordBatch:
            token, kind, count = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(token, kind="stable")
            starts = run_bounds(token[order])[:-1]
            arrays = [token[order][starts], kind[order][starts], np.add.reduceat(count[order], starts)]
            return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["token", "kind", "c"])

        for batch in batches:
            for _, data, offsets in chunks(batch, "text"):
                hashes, kinds, _ = tokens(data, offsets)
                found, first, count = np.unique(hashes, return_index=True, return_counts=True)
                held.append((found, kinds[first], count))
                size += len(found)
                if size > 1_000_000:
                    yield merged()
                    held, size = [], 0
        if held:
            yield merged()

    parts = texts.where(~F.col("held_out")).select("text").mapInArrow(run, "token bigint, kind bigint, c bigint")
    return materialize(parts.groupBy("token").agg(F.min("kind").alias("kind"), F.sum("c").alias("c")), "counts")


@dataclass
class Lexicon:
    """Bounded part of the counts that tasks hold."""

    head: np.ndarray  # sorted hashes of frequent words
    head_counts: np.ndarray
    model: np.ndarray  # sorted hashes of the words in word classes
    model_ids: np.ndarray
    total: int
    distinct: int
    rare_mass: np.ndarray  # N + 0.5 (V + 1) per rare class
    class_bias: np.ndarray
    word_bias: np.ndarray

    def model_id(self, hashes: np.ndarray) -> np.ndarray:
        """Number of a word in the word classes, -1 for all others."""
        if not len(self.model):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.model, hashes), len(self.model) - 1)
        return np.where(self.model[at] == hashes, self.model_ids[at], -1)


def lexicon(counts: DataFrame, head_limit: int = HEAD) -> Lexicon:
    """Frequent words down to the lowest count with at most ``head_limit`` words at or above it."""
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    by_count = counts.groupBy("c").agg(F.count("*").alias("n"))  # few distinct counts
    above = F.sum("n").over(W.orderBy(F.col("c").desc()).rowsBetween(W.unboundedPreceding, 0))
    least = by_count.withColumn("above", above).where(F.col("above") <= head_limit).agg(F.min("c")).first()[0]
    head = counts.where(F.col("c") >= (least if least is not None else 1 << 62)).toArrow()  # head_limit rows at most
    token, kind, c = (head[x].to_numpy() for x in ("token", "kind", "c"))
    order = np.argsort(token)
    token, kind, c = token[order], kind[order], c[order]
    top = np.lexsort((token, -c))[:WORDS]
    rare = counts.groupBy("kind").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()  # RARE rows at most
    mass, number = np.zeros(RARE), np.zeros(RARE)
    for r in rare:
        mass[r["kind"]], number[r["kind"]] = r["c"], r["n"]
    np.subtract.at(mass, kind[top], c[top])
    np.subtract.at(number, kind[top], 1)
    by_class = np.zeros(CLASSES)
    ids = np.arange(len(top))
    np.add.at(by_class, ids // CLASS_WORDS, c[top])
    words_in = np.zeros(WORDS)
    words_in[: len(top)] = c[top]
    sorted_top = np.argsort(token[top])
    return Lexicon(
        token, c, token[top][sorted_top], ids[sorted_top], int(total), int(distinct), mass + 0.5 * (number + 1),
        np.log(np.concatenate([by_class, mass]) + 0.5).astype(np.float32), np.log(words_in + 0.5).astype(np.float32),
    )


class Tables:
    """Weights of the two softmaxes."""

    def __init__(self, known: Lexicon) -> None:
        self.known = known
        self.class_tables = [np.zeros((n, WIDE), np.float32) for n in (CONTEXTS, CONTEXTS, PAIRS)]
        self.word_tables = [np.zeros((NEAR * CLASSES, CLASS_WORDS), np.float32) for _ in range(2)]
        self.word_bias = known.word_bias.reshape(CLASSES, CLASS_WORDS)

    def all(self) -> list[np.ndarray]:
        return [*self.class_tables, *self.word_tables]

    def contexts(self, hashes: np.ndarray, kinds: np.ndarray, begun: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Class and place in the class of each token, and the rows its context reads in each table."""
        n = len(hashes)
        ids = self.known.model_id(hashes)
        frequent = ids >= 0
        label = np.where(frequent, ids // CLASS_WORDS, CLASSES + kinds)
        own = np.where(frequent, ids, WORDS + mix(hashes.view(np.uint64)).view(np.int64) % (CONTEXTS - WORDS - 1))
        near = np.where(frequent, ids, WORDS + kinds)
        wide, close = [], []
        start = np.zeros(n, bool)
        start[begun[:-1]] = True
        for back in (1, 2):
            if back == 2:
                start[np.minimum(begun[:-1] + 1, n - 1)] = True
            far, close_far = np.full(n, CONTEXTS - 1), np.full(n, NEAR - 1)
            far[back:], close_far[back:] = own[:-back], near[:-back]
            far[start], close_far[start] = CONTEXTS - 1, NEAR - 1
            wide.append(far)
            close.append(close_far)
        pair = mix((wide[0] * CONTEXTS + wide[1]).astype(np.uint64)) % np.uint64(PAIRS)
        return label, ids % CLASS_WORDS, [*wide, pair.astype(np.int64)], [c * CLASSES + np.minimum(label, CLASSES - 1) for c in close]

    @staticmethod
    def _weights(bias: np.ndarray, tables: list[np.ndarray], rows: list[np.ndarray]) -> np.ndarray:
        """Logits less the largest of each row."""
        logits = tables[0].take(rows[0], 0)
        for table, at in zip(tables[1:], rows[1:], strict=True):
            logits += table.take(at, 0)
        logits += bias
        logits -= logits.max(1, keepdims=True)
        return logits

    def _softmax(self, bias: np.ndarray, tables: list[np.ndarray], rows: list[np.ndarray]) -> np.ndarray:
        p = self._weights(bias, tables, rows)
        np.exp(p, out=p)
        p *= (1.0 / (p @ np.ones(p.shape[1], np.float32)))[:, None]
        return p

    def _log_softmax(self, bias: np.ndarray, tables: list[np.ndarray], rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
        """Log probability of one column per row."""
        logits = self._weights(bias, tables, rows)
        own = logits[np.arange(len(y)), y].astype(np.float64)
        np.exp(logits, out=logits)
        return own - np.log((logits @ np.ones(logits.shape[1], np.float32)).astype(np.float64))

    def log10(self, hashes: np.ndarray, kinds: np.ndarray, begun: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of P(class) * P(word | class) for frequent words and of P(class) alone for rare ones; which are frequent."""
        label, place, wide, close = self.contexts(hashes, kinds, begun)
        result = np.empty(len(hashes))
        for at in range(0, len(hashes), BATCH):
            part = slice(at, at + BATCH)
            y = label[part]
            result[part] = self._log_softmax(self.known.class_bias, self.class_tables, [w[part] for w in wide], y)
            inner = np.flatnonzero(y < CLASSES)
            if len(inner):
                result[at + inner] += self._log_softmax(self.word_bias.take(y[inner], 0), self.word_tables, [c[part][inner] for c in close], place[part][inner])
        result /= np.log(10.0)
        return result, label < CLASSES

    def learn(self, hashes: np.ndarray, kinds: np.ndarray, begun: np.ndarray, seen: list[np.ndarray]) -> None:
        """Gradient steps over the tokens in order; ``seen`` counts how often each row was read."""
        label, place, wide, close = self.contexts(hashes, kinds, begun)
        for at in range(0, len(hashes), BATCH):
            part = slice(at, at + BATCH)
            y, rows = label[part], [w[part] for w in wide]
            p = self._softmax(self.known.class_bias, self.class_tables, rows)
            p[np.arange(len(y)), y] -= 1
            for table, row, count in zip(self.class_tables, rows, seen, strict=False):
                _descend(table, count, row, p)
            inner = np.flatnonzero(y < CLASSES)
            if len(inner):
                rows = [c[part][inner] for c in close]
                p = self._softmax(self.word_bias.take(y[inner], 0), self.word_tables, rows)
                p[np.arange(len(inner)), place[part][inner]] -= 1
                for table, row, count in zip(self.word_tables, rows, seen[len(self.class_tables) :], strict=True):
                    _descend(table, count, row, p)


def _descend(table: np.ndarray, seen: np.ndarray, row: np.ndarray, gradient: np.ndarray) -> None:
    """Add up the gradient per row and step, less the oftener a row has been seen."""
    order = np.argsort(row.astype(np.uint16) if len(table) <= 1 << 16 else row, kind="stable")
    bounds = run_bounds(row[order])
    starts, n = bounds[:-1], np.diff(bounds)
    rows = row[order[starts]]
    seen[rows] += n
    # Rows met often are summed one by one, all others together: first visits, then second ones, and so on.
    sums = gradient.take(order[starts], 0)
    for k in np.flatnonzero(n > OFTEN).tolist():
        sums[k] = np.add.reduce(gradient.take(order[starts[k] : starts[k] + n[k]], 0), axis=0)
    some, visit = np.flatnonzero((n > 1) & (n <= OFTEN)), 1
    while len(some):
        sums[some] += gradient.take(order[starts[some] + visit], 0)
        visit += 1
        some = some[n[some] > visit]
    table[rows] -= RATE * sums / np.sqrt(seen[rows])[:, None].astype(np.float32)


def dealt_texts(texts: DataFrame, part_bytes: int) -> tuple[DataFrame | None, int, int]:
    """(round, part, doc_id, text) of the texts to learn from, and the numbers of rounds and parts.

    Parts of about ``part_bytes`` follow from a hash of the rows, and their number from the bytes of all texts; there are
    as many rounds as each has parts. More data means more rounds and more parts in each.
    """
    learned = texts.where(~F.col("held_out")).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    held = learned.agg(F.sum(F.octet_length("text") + F.lit(1)).alias("n")).first()["n"]
    if not held:
        return None, 0, 0
    parts = -(-held // part_bytes)
    rounds = int(np.ceil(np.sqrt(parts)))
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int")
    dealt = learned.withColumn("part", part).withColumn("round", F.pmod("part", F.lit(rounds)).cast("int"))
    path = new_path(texts.sparkSession, "dealt")
    dealt.write.partitionBy("round").parquet(path)
    return texts.sparkSession.read.schema(dealt.schema).parquet(path), rounds, parts


def train(texts: DataFrame, known: Lexicon, part_bytes: int = PART_BYTES) -> Tables:
    """One pass over all texts not held out, in rounds that each start from the averaged tables of the one before."""
    context = texts.sparkSession.sparkContext
    model = Tables(known)
    seen = [np.zeros(len(t)) for t in model.all()]
    dealt, rounds, parts = dealt_texts(texts, part_bytes)
    shapes = [t.shape for t in model.all()]
    schema = "part int, rows binary, change binary, seen binary"

    def packed(part: int, rows: np.ndarray, change: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        raw = [pa.array([x.tobytes()], pa.binary()) for x in (rows.astype(np.int32), change, count)]
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *raw], ["part", "rows", "change", "seen"])

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total, count, times = None, None, None, None

        def result() -> pa.RecordBatch:
            rows = np.flatnonzero(times)
            return packed(current, rows, (total[rows] / times[rows][:, None]).astype(np.float32), count[rows] / times[rows])

        for batch in batches:  # sorted by part; one table block is added up at a time
            for k in range(batch.num_rows):
                part = batch.column("part")[k].as_py()
                if part != current:
                    if current is not None:
                        yield result()
                    shape = shapes[part // BLOCKS]
                    current, total, count, times = part, np.zeros(shape), np.zeros(shape[0]), np.zeros(shape[0])
                rows = np.frombuffer(batch.column("rows")[k].as_buffer(), np.int32)
                total[rows] += np.frombuffer(batch.column("change")[k].as_buffer(), np.float16).reshape(len(rows), -1)
                count[rows] += np.rint(np.frombuffer(batch.column("seen")[k].as_buffer(), np.float64))  # whole, so that the order of parts is of no matter
                times[rows] += 1
        if current is not None:
            yield result()

    for turn in range(rounds):
        shared = context.broadcast((model, seen))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            begin, before = shared.value
            for table in key_runs(batches, ["part"]):
                bounds = run_bounds(table["part"].to_numpy())
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    own, counts = Tables(begin.known), [c.copy() for c in before]
                    for mine, start in zip(own.all(), begin.all(), strict=True):
                        mine[:] = start
                    # One batch per part, so steps do not depend on the size of Arrow batches.
                    whole = pa.RecordBatch.from_arrays([table["text"].slice(a, b - a).cast(pa.large_string()).combine_chunks()], ["text"])
                    for _, data, offsets in chunks(whole, "text"):
                        own.learn(*tokens(data, offsets), counts)
                    for number, (mine, start, count, old) in enumerate(zip(own.all(), begin.all(), counts, before, strict=True)):
                        moved = np.flatnonzero(count > old)
                        for block in range(BLOCKS):
                            rows = moved[moved % BLOCKS == block]
                            if len(rows):
                                yield packed(number * BLOCKS + block, rows, (mine[rows] - start[rows]).astype(np.float16), count[rows])

        # One task per part, and one per block of the tables.
        place = F.floor(F.col("part") / rounds).cast("int")
        given = dealt.where(F.col("round") == turn).select("part", "doc_id", "text", F.xxhash64("text").alias("h"), place.alias("place"))
        given = given.repartitionById(-(-parts // rounds), "place").sortWithinPartitions("part", "doc_id", "h").select("part", "text")
        changes = given.mapInArrow(run, schema).withColumn("block", F.pmod("part", F.lit(BLOCKS))).repartitionById(BLOCKS, "block").drop("block")
        summed = changes.sortWithinPartitions("part").mapInArrow(average, schema)
        for row in summed.toLocalIterator():  # at most one row per table block, 20 MB in all
            at = row["part"] // BLOCKS
            rows = np.frombuffer(row["rows"], np.int32)
            model.all()[at][rows] += np.frombuffer(row["change"], np.float32).reshape(len(rows), -1)
            seen[at][rows] = np.frombuffer(row["seen"], np.float64)
        shared.unpersist()
    return model


def score_texts(docs: DataFrame, head_limit: int = HEAD, part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs`` (doc_id, text, ...).

    ``base_score`` is the smoothed unigram log10 probability, ``score`` the model's. A null or empty text is its end alone.
    Repeated rows are scored alike and learned from as often as they stand there; without training texts every token is
    unknown. An empty table gives no rows; other columns are left aside.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    counts = count_tokens(texts)
    known = lexicon(counts, head_limit)
    model = spark.sparkContext.broadcast(train(texts, known, part_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.value
        lex = tables.known
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        scale = np.log10(lex.total + 0.5 * (lex.distinct + 1))
        rare = np.log10(lex.rare_mass)
        for batch in batches:
            for rows, data, offsets in chunks(batch, "text"):
                hashes, kinds, begun = tokens(data, offsets)
                doc = np.repeat(np.arange(rows.num_rows), np.diff(begun))
                found, inverse = np.unique(hashes, return_inverse=True)
                c = np.full(len(found), -1, np.int64)
                if len(lex.head):
                    at = np.minimum(np.searchsorted(lex.head, found), len(lex.head) - 1)
                    c = np.where(lex.head[at] == found, lex.head_counts[at], -1)
                count = c[inverse]
                in_head = count >= 0
                logs = np.where(in_head, np.log10(np.maximum(count, 0) + 0.5), 0.0)
                parts, frequent = tables.log10(hashes, kinds, begun)
                parts += np.where(frequent, 0.0, logs - rare[kinds])
                summed = lambda x, d=doc, n=rows.num_rows: np.bincount(d, x, minlength=n)
                ids = pa.array(number + np.arange(rows.num_rows))
                n = np.diff(begun)
                none = pa.nulls(rows.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids, rows.column("doc_id"), rows.column("held_out"), pa.array(n), pa.array(summed(in_head.astype(float)).astype(np.int64)), pa.array(summed(logs) - n * scale), pa.array(summed(parts)), none, none],
                    names,
                )
                number += rows.num_rows
                # Words beyond the head, once per text, to meet their counts in a join.
                out = np.flatnonzero(~in_head)
                if len(out):
                    order = out[np.lexsort((inverse[out], doc[out]))]
                    starts = run_bounds(doc[order], inverse[order])
                    where = order[starts[:-1]]
                    k = len(where)
                    empty = [pa.nulls(k, t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(doc[where])), *empty, pa.array(hashes[where]), pa.array(np.diff(starts))], names)

    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "token", "times"]
    schema = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, token bigint, times bigint"
    scored = materialize(texts.mapInArrow(run, schema), "scored")
    tail = scored.where("token IS NOT NULL").select("row", "token", "times").join(counts.select("token", "c"), "token", "left")
    log = F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5))
    late = tail.groupBy("row").agg(F.sum(F.col("times") * log).alias("log"), F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("known"))
    head = scored.where("token IS NULL").drop("token", "times")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return head.join(late, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + zero("known")).alias("n_known"),
        F.lit(known.total).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + zero("log")).alias("base_score"),
        (F.col("score") + zero("log")).alias("score"),
    )
