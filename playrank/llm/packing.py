"""Pack documents into sequences of a fixed capacity so that the sequences cost about the same.

A piece of L tokens costs ``linear * L + quadratic * L * L``: the layers' work per token and attention inside the piece.
A task gathers the ends of its documents until they fill ``sequences`` sequences, then takes them in descending order
and gives each to the lowest-cost sequence that still has room for it. A piece that fits nowhere is cut: its first part
fills the lowest-cost sequence with any room, the rest is dealt like a shorter document. Documents beyond the capacity
fill whole sequences first. All these sequences are full.

What a task cannot fill a sequence with, less than one capacity, is left open. The open pieces of many tasks are
packed together in a second, small step, so padding does not grow with the number of tasks. The few tokens that remain
there go into sequences whose lengths are powers of two, which need no padding.

Texts are tokenized once, in the task that reads them, and never shuffled.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playrank.llm.text import chunks
from playrank.llm.token_ids import shared_encoder
from playrank.session import materialize

OPEN_TOGETHER = 256  # tasks whose open pieces are packed together
ROWS = 4096  # pieces per batch that leaves a task
SECOND = 1 << 30  # numbers of the second step's sequences begin above all of the first


class Packer:
    """Packing inside one task; holds about ``sequences`` sequences of tokens."""

    def __init__(self, number: int, capacity: int, sequences: int, linear: float, quadratic: float) -> None:
        self.base, self.made = number << 32, 0
        self.capacity, self.sequences = capacity, sequences
        self.linear, self.quadratic = linear, quadratic
        self.pool: list[tuple] = []  # (document, start, ids, tokens of the document)
        self.held = 0
        self.rows: list[tuple] = []  # (document, start, ids, tokens of the document, sequence, offset)

    def add(self, doc: object, start: int, ids: np.ndarray, total: int) -> None:
        cap = self.capacity
        whole = len(ids) // cap
        for k in range(whole):
            self._close([(doc, start + k * cap, ids[k * cap : (k + 1) * cap], total)])
        if len(ids) > whole * cap:
            self.pool.append((doc, start + whole * cap, ids[whole * cap :], total))
            self.held += len(ids) - whole * cap
        if self.held >= self.sequences * cap:
            self.fill()

    def _close(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, ids, total, self.base + self.made, at))
            at += len(ids)
        self.made += 1

    def fill(self) -> None:
        """Fill as many sequences as the pool can; the tokens left over stay in it."""
        m = self.held // self.capacity
        if not m:
            return
        room, cost = np.full(m, self.capacity), np.zeros(m)
        dealt: list[list[tuple]] = [[] for _ in range(m)]
        queue = [(-len(p[2]), k, p) for k, p in enumerate(self.pool)]
        heapq.heapify(queue)
        number, left = len(queue), m * self.capacity
        while left:
            size, k, (doc, start, ids, total) = heapq.heappop(queue)
            open_to = room >= -size
            if not open_to.any():
                open_to = room > 0
            to = int(np.where(open_to, cost, np.inf).argmin())
            n = min(-size, int(room[to]))
            dealt[to].append((doc, start, ids[:n], total))
            room[to] -= n
            cost[to] += self.linear * n + self.quadratic * n * n
            left -= n
            if n < -size:
                heapq.heappush(queue, (n + size, number, (doc, start + n, ids[n:], total)))
                number += 1
        for pieces in dealt:
            self._close(pieces)
        self.pool = [p for _, _, p in sorted(queue, key=lambda q: q[:2])]
        self.held -= m * self.capacity

    def last(self) -> None:
        """Close what is left in sequences whose lengths are powers of two, the longest first."""
        self.fill()
        pool = self.pool[::-1]
        for bit in reversed(range(self.held.bit_length())):
            want, pieces = self.held & (1 << bit), []
            while want:
                doc, start, ids, total = pool.pop()
                n = min(want, len(ids))
                pieces.append((doc, start, ids[:n], total))
                if n < len(ids):
                    pool.append((doc, start + n, ids[n:], total))
                want -= n
            if pieces:
                self._close(pieces)
        self.pool, self.held = [], 0

    def batch(self, schema: pa.Schema, number: int, open_rows: bool = False) -> pa.RecordBatch:
        """What has been closed, or the open pieces, as rows."""
        rows = [(*p, None, k) for k, p in enumerate(self.pool)] if open_rows else self.rows
        if not open_rows:
            self.rows = []
        docs, starts, ids, totals, sequences, offsets = zip(*rows, strict=True) if rows else [()] * 6
        columns = [docs, starts, [len(i) for i in ids], totals, sequences, offsets, [i.astype("<u4").tobytes() for i in ids], [number] * len(rows)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def pack_documents(
    docs: DataFrame, vocabulary_path: str, capacity: int = 2048, end_id: int = 1, sequences: int = 512, linear: float = 1.0, quadratic: float = 1 / 6144
) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, tokens) for every piece of every row of ``docs`` (doc_id, text, ...).

    A document is its text's ids and ``end_id`` behind them. ``start`` counts the document's ids before the piece,
    ``offset`` those before it in its sequence; ``tokens`` are the piece's ids as little-endian unsigned 32-bit numbers,
    ready to be laid into a training file. Lengths inside a sequence add up to ``capacity``, or to a power of two in the
    last sequences of a packed group of tasks, so nothing is padded.

    A null or empty text is a document of the end id alone. Repeated rows are documents of their own, whatever their ids;
    a null id stays null. A text of any length is cut into as many pieces as it fills. Other columns are left aside,
    whatever their names. An empty table gives no rows. Memory in a task is bounded by ``sequences`` and one text.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
            T.StructField("tokens", T.BinaryType()),
            T.StructField("part", T.IntegerType()),
        ]
    )

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        packer, encoder, arrow = Packer(number, capacity, sequences, linear, quadratic), None, None
        for batch in batches:
            encoder = encoder or shared_encoder(shared.value)
            arrow = arrow or _arrow(batch.schema.field("doc_id").type)
            for rows, _, _ in chunks(batch, "text"):
                texts = [t or "" for t in rows.column("text").to_pylist()]
                for doc, ids in zip(rows.column("doc_id").to_pylist(), encoder.encode(texts), strict=True):
                    packer.add(doc, 0, np.append(ids, np.uint32(end_id)), len(ids) + 1)
                if len(packer.rows) >= ROWS:
                    yield packer.batch(arrow, number)
        if arrow:
            packer.fill()
            yield packer.batch(arrow, number)
            yield packer.batch(arrow, number, open_rows=True)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        packer, arrow = Packer(SECOND + number, capacity, sequences, linear, quadratic), None
        for batch in batches:
            arrow = arrow or _arrow(batch.schema.field("doc_id").type)
            for row in batch.to_pylist():
                packer.add(row["doc_id"], row["start"], np.frombuffer(row["tokens"], "<u4"), row["doc_tokens"])
        if arrow:
            packer.last()
            yield packer.batch(arrow, number)

    pieces = materialize(docs.mapInArrow(first, schema), "pieces")
    # ``part`` and ``offset`` (a place in the pool) give the open pieces one order, so a task run again packs alike.
    open_pieces = pieces.where("sequence_id IS NULL").repartition(F.expr(f"part div {OPEN_TOGETHER}")).sortWithinPartitions("part", "offset")
    return pieces.where("sequence_id IS NOT NULL").unionByName(open_pieces.mapInArrow(second, schema)).drop("part")


def _arrow(doc_id: pa.DataType) -> pa.Schema:
    number = pa.int64()
    return pa.schema([("doc_id", doc_id), ("start", number), ("length", number), ("doc_tokens", number), ("sequence_id", number), ("offset", number), ("tokens", pa.binary()), ("part", pa.int32())])
