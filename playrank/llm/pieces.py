"""SentencePiece BPE encoding and decoding with a table of each prefix's last token.

An encoding is right exactly if all its neighbouring tokens are compatible, that is, if no merge crosses their border
before both are complete; and each prefix of a text has one last token. An automaton gives all vocabulary pieces that
end at a character; the one that is compatible with the last token of the prefix before it goes into the table. The ids
are then read off the table from the end backwards. Work is linear in the text, whatever its merges.

White space begins a piece and never stands inside one, and a character that no piece holds never merges, so a text is cut there into
short spans that are encoded on their own; spans met are kept in a bounded table per worker process. The new spans of
many texts go through the table together: matches of all spans come from one walk of the pieces' trie, a character deeper
per step, and the prefixes of one length are decided at once.

Decoding knows nothing of the text: it takes an id list and puts the pieces of its ids together.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playrank.llm.text import chunks

MARK = "▁"  # stands for a space
SPANS_KEPT = 400_000  # encoded spans kept per process,
CHARS_KEPT = 16_000_000  # and their characters
LONGEST = 64  # characters; longer spans are encoded one by one
UNKNOWN = -1
NEVER = 1 << 60


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id; at most as large as the model file."""

    ids: dict[str, int]  # normal pieces
    order: list[int]  # merge rank by id: lower merges first
    byte_ids: list[int]
    texts: list[str | None]  # what an id decodes to; None for bytes
    bytes_of: dict[int, int]
    name: str  # tells one model from another

    @staticmethod
    def load(path: str) -> Vocabulary:
        """Read a model file on the driver; tasks get the table."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        name = hashlib.sha256(model.serialized_model_proto()).hexdigest()
        n = model.vocab_size()
        ids, texts, byte_ids, bytes_of = {}, [], [0] * 256, {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                bytes_of[i] = int(piece[3:5], 16)
                texts.append(None)
            elif model.is_control(i):
                texts.append("")
            elif model.is_unknown(i):
                texts.append(" ⁇ ")
            else:
                ids[piece] = i
                texts.append(piece)
        ranked = sorted(ids.values(), key=lambda i: (-model.get_score(i), i))
        order = [NEVER] * n
        for place, i in enumerate(ranked):
            order[i] = place
        if not bytes_of:
            raise ValueError("the model needs byte pieces")
        if any(c not in ids for piece in ids for c in piece):
            raise ValueError("a piece holds a character that is no piece itself")
        return Vocabulary(ids, order, byte_ids, texts, bytes_of, name)


class _Numbers:
    """Numbers (0 and above, below 2^31) by 64-bit keys (0 and above), looked up for whole arrays at once; -1 for an unknown key."""

    def __init__(self, bits: int) -> None:
        self.bits, self.held = bits, 0
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slots(keys)
        there = self.keys[slot]
        found = np.where(there == keys, self.values[slot], np.int32(-1))
        open_ = np.flatnonzero((there != keys) & (there != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            there = self.keys[slot[open_]]
            same = there == keys[open_]
            found[open_[same]] = self.values[slot[open_[same]]]
            open_ = open_[~same & (there != -1)]
        return found

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Keys that are all different and not held yet."""
        while 2 * (self.held + len(keys)) > len(self.keys):
            old = np.flatnonzero(self.keys >= 0)
            old_keys, old_values = self.keys[old], self.values[old]
            self.__init__(self.bits + 1)
            self.put(old_keys, old_values)
        self.held += len(keys)
        slot, open_ = self._slots(keys), np.arange(len(keys))
        while len(open_):
            free = open_[self.keys[slot[open_]] == -1]
            self.keys[slot[free]] = keys[free]  # of several that want one slot, the last gets it
            own = self.keys[slot[open_]] == keys[open_]
            self.values[slot[open_[own]]] = values[open_[own]]
            open_ = open_[~own]
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)


class _Spans(dict):
    """Span numbers by what stands behind ``mark`` in the text; a new span is put down to be coded with others."""

    def __init__(self, coder: PieceCoder, mark: str) -> None:
        self.coder, self.mark = coder, mark

    def __missing__(self, rest: str) -> int:
        number = self[rest] = len(self.coder.id_text) + len(self.coder.new)
        self.coder.new.append(self.mark + rest)
        return number


class PieceCoder:
    """Encoder and decoder over a vocabulary; ``shared_coder`` gives one per worker process."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.single = frozenset(p for p in vocabulary.ids if len(p) == 1)
        self.text = {i: p for p, i in vocabulary.ids.items()}
        self.size = len(vocabulary.texts)
        self._right: dict[int, list[tuple[int, int, int]]] = {}
        self._left: dict[int, list[tuple[int, int, int]]] = {}
        self._split: dict[int, tuple[int, int] | None] = {}
        self._fits: dict[int, bool] = {}
        self.digits = [str(i) for i in range(self.size)]
        self.digit_width = np.array([len(d) for d in self.digits])
        # What an id decodes to by itself. A byte below 128 is a character wherever it stands; others are read by runs.
        self.shown = [chr(vocabulary.bytes_of[i]) if t is None else t.replace(MARK, " ") for i, t in enumerate(vocabulary.texts)]
        self.in_run = np.array([vocabulary.bytes_of.get(i, 0) >= 0x80 for i in range(self.size)])
        self._forget()
        self._pairs = _Numbers(20)
        # Merging makes a piece of one character and those that have a last merge; no other piece is ever a token.
        made = {p: i for p, i in vocabulary.ids.items() if len(p) == 1 or self.split(i) is not None}
        self.matches = ahocorasick.Automaton()
        for piece, i in made.items():
            self.matches.add_word(piece, (i, len(piece)))
        self.matches.make_automaton()
        self._plant(made)
        joined = "".join(p for p in vocabulary.ids)
        self.width = np.array([len(self.text.get(i, " ")) for i in range(self.size)])
        self.feed_alone = "\n" not in joined
        stop = f"{MARK}\n" if self.feed_alone else MARK
        self.cut = re.compile(f"{MARK}+[^{stop}]*|[^{stop}]+|\n" if self.feed_alone else f"{MARK}+[^{stop}]*|[^{stop}]+")

    def _forget(self) -> None:
        self.marked, self.plain = _Spans(self, MARK), _Spans(self, "")
        self.new: list[str] = []
        self.id_text: list[str] = []  # by span number: its ids as text
        self.ids, self.bounds, self.chars = np.empty(0, np.int32), np.zeros(1, np.int64), 0

    def _plant(self, pieces: dict[str, int]) -> None:
        """The trie of the pieces, its edges in one table: node * letters + letter to node."""
        letters = {c: k + 1 for k, c in enumerate(sorted({c for p in pieces for c in p}))}
        self.letters = len(letters) + 1
        self.letter_of = np.zeros(0x110000, np.int32)  # 0 for a character that no piece holds
        self.letter_of[[ord(c) for c in letters]] = list(letters.values())
        edges: dict[int, int] = {}
        piece_at = [-1]
        for piece, i in pieces.items():
            node = 0
            for c in piece:
                key = node * self.letters + letters[c]
                if key not in edges:
                    edges[key] = len(piece_at)
                    piece_at.append(-1)
                node = edges[key]
            piece_at[node] = i
        self.piece_at = np.array(piece_at, np.int64)
        self.edges = _Numbers(18)
        self.edges.put(np.fromiter(edges.keys(), np.int64, len(edges)), np.fromiter(edges.values(), np.int32, len(edges)))

    def rank(self, i: int) -> int:
        return -1 if len(self.text[i]) == 1 else self.v.order[i]

    def split(self, i: int) -> tuple[int, int] | None:
        """The last merge that makes a piece out of its characters; None for a character or a piece merging never makes."""
        if i not in self._split:
            self._split[i] = self._last_merge(self.text[i])
        return self._split[i]

    def _last_merge(self, piece: str) -> tuple[int, int] | None:
        ids, order = self.v.ids, self.v.order
        parts, last = list(piece), None
        while len(parts) > 1:
            best, at = NEVER, -1
            for k in range(len(parts) - 1):
                found = ids.get(parts[k] + parts[k + 1])
                if found is not None and order[found] < best:
                    best, at = order[found], k
            if at < 0:
                return None
            last = (ids[parts[at]], ids[parts[at + 1]])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return last

    def _spine(self, i: int, side: int) -> list[tuple[int, int, int]]:
        """(piece, made at, used up at) of what stood at a piece's border while it was made."""
        store = self._left if side == 0 else self._right
        if i not in store:
            result, until, at = [], NEVER, i
            while True:
                made = self.rank(at)
                result.append((at, made, until))
                parts = self.split(at)
                if parts is None:
                    break
                until, at = made, parts[side]
            store[i] = result
        return store[i]

    def fits(self, a: int, b: int) -> bool:
        """Whether two pieces can stand side by side: no merge joined their borders on the way."""
        key = a * self.size + b
        known = self._fits.get(key)
        if known is None:
            known = self._fits[key] = self._meets_nowhere(a, b)
        return known

    def _meets_nowhere(self, a: int, b: int) -> bool:
        ids, order, text = self.v.ids, self.v.order, self.text
        for left, left_made, left_until in self._spine(a, 1):
            for right, right_made, right_until in self._spine(b, 0):
                # Of equal ranks the one further left comes first.
                if left_made > right_until or right_made >= left_until:
                    continue
                joined = ids.get(text[left] + text[right])
                if joined is not None and order[joined] < left_until and order[joined] <= right_until:
                    return False
        return True

    def encode_span(self, span: str) -> list[int]:
        n = len(span)
        last = [0] * (n + 1)  # 1 + the last token of each prefix, 0 where it is open
        width = [1] * (n + 1)
        if not self.single.issuperset(span):
            for k, c in enumerate(span):
                if c not in self.single:
                    last[k + 1] = UNKNOWN
        fits, size = self._fits, self.size
        for end, (i, length) in self.matches.iter(span):
            end += 1
            if last[end]:
                continue
            start = end - length
            if start:
                before = last[start]
                if not before:
                    continue
                if before > 0:
                    known = fits.get((before - 1) * size + i)
                    if known is None:
                        known = self.fits(before - 1, i)
                    if not known:
                        continue
            last[end], width[end] = i + 1, length
        ids: list[int] = []
        at = n
        while at:
            i = last[at]
            if i > 0:
                ids.append(i - 1)
            elif i == UNKNOWN:
                ids.extend(self.v.byte_ids[b] for b in reversed(span[at - 1].encode()))
            else:
                raise RuntimeError(f"no token ends at {at} of {span!r}")
            at -= width[at]
        ids.reverse()
        return ids

    def _fitting(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """``fits`` for whole arrays."""
        key = before * self.size + after
        known = self._pairs.get(key)
        new = np.unique(key[known < 0])
        if len(new):
            self._pairs.put(new, np.array([self._meets_nowhere(*divmod(k, self.size)) for k in new.tolist()], np.int32))
            known = self._pairs.get(key)
        return known == 1

    def encode_spans(self, spans: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many spans one after the other, and where each begins (and the end). All characters are pieces."""
        size = np.array([len(s) for s in spans], np.int64)
        letter = self.letter_of[np.frombuffer("".join(spans).encode("utf-32-le"), np.uint32)]
        stop = np.cumsum(size)
        # Every span has a place for each of its prefixes, the empty one included.
        owner = np.repeat(np.arange(len(spans)), size)
        at, node, end = np.arange(len(letter)), np.zeros(len(letter), np.int64), stop[owner]
        starts, lengths, pieces = [], [], []
        depth = 0
        while len(at):
            inside = at + depth < end[at]
            at, node = at[inside], node[inside]
            node = self.edges.get(node * self.letters + letter[at + depth]).astype(np.int64)
            at, node = at[node >= 0], node[node >= 0]
            depth += 1
            piece = self.piece_at[node]
            starts.append(at[piece >= 0])
            lengths.append(np.full(len(starts[-1]), depth))
            pieces.append(piece[piece >= 0])
        start, length, piece = np.concatenate(starts), np.concatenate(lengths), np.concatenate(pieces)
        level = start + length - (stop - size)[owner[start]]
        order = np.argsort(level.astype(np.uint16), kind="stable")  # within a level lengths rise as they did before
        start, length, piece, level = start[order], length[order], piece[order], level[order]
        here = start + owner[start]
        first = start == (stop - size)[owner[start]]
        last = np.full(len(letter) + len(spans), -1, np.int64)
        edges = np.searchsorted(level, np.arange(1, int(size.max()) + 2))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            before = last[here[a:b]]
            open_ = first[a:b] | (before >= 0)
            inner = np.flatnonzero(open_ & ~first[a:b])
            open_[inner] = self._fitting(before[inner], piece[a:b][inner])
            chosen = np.flatnonzero(open_) + a
            last[here[chosen] + length[chosen]] = piece[chosen]  # one fits; longer ones come last
        # Back from the end of each span, all spans a token at a time.
        place, number = stop + np.arange(len(spans)), np.arange(len(spans))
        begin = place - size
        steps = []
        while len(number):
            token = last[place]
            if (token < 0).any():
                raise RuntimeError(f"no token ends in {spans[int(number[token < 0][0])]!r}")
            steps.append((number, token))
            place = place - self.width[token]
            going = place > begin
            place, begin, number = place[going], begin[going], number[going]
        count = np.bincount(np.concatenate([n for n, _ in steps]), minlength=len(spans))
        bounds = np.concatenate([[0], np.cumsum(count)])
        ids = np.empty(int(bounds[-1]), np.int32)
        for k, (number, token) in enumerate(steps):
            ids[bounds[number + 1] - 1 - k] = token
        return ids, bounds

    def _learn(self) -> None:
        """Code the spans put down since the last time."""
        spans, self.new = self.new, []
        if not spans:
            return
        size = np.fromiter(map(len, spans), np.int64, len(spans))
        self.chars += int(size.sum())
        known = np.add.reduceat(self.letter_of[np.frombuffer("".join(spans).encode("utf-32-le"), np.uint32)] == 0, np.cumsum(size) - size) == 0
        together = known & (size <= LONGEST)
        # Those coded one by one come last; numbers were given in the order of the spans.
        alone = np.flatnonzero(~together).tolist()
        flat, bounds = self.encode_spans([spans[k] for k in np.flatnonzero(together).tolist()] if alone else spans) if together.any() else (np.empty(0, np.int32), np.zeros(1, np.int64))
        id_text = self._id_texts(flat, bounds)
        if alone:
            lists = np.split(flat, bounds[1:-1]) if together.any() else []
            for k in alone:
                ids = self.encode_span(spans[k])
                lists.insert(k, np.array(ids, np.int32))
                id_text.insert(k, ",".join([self.digits[i] for i in ids]))
            flat, bounds = np.concatenate(lists), np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        self.id_text += id_text
        self.bounds = np.concatenate([self.bounds, len(self.ids) + bounds[1:]])
        self.ids = np.concatenate([self.ids, flat])

    def _id_texts(self, flat: np.ndarray, bounds: np.ndarray) -> list[str]:
        """By span: its ids as text, cut out of one long text."""
        ids = ",".join(map(self.digits.__getitem__, flat.tolist()))
        cut = np.concatenate([[0], np.cumsum(self.digit_width[flat] + 1)])[bounds].tolist()
        return [ids[a : b - 1] for a, b in zip(cut[:-1], cut[1:], strict=True)]

    def _numbers(self, text: str) -> list[int]:
        """Span numbers of a text. Where each space stands alone, spans are what lies between spaces and line feeds."""
        if not text:
            return []
        marked, plain = self.marked.__getitem__, self.plain.__getitem__
        if not self.feed_alone or "  " in text or text[0] == " " or MARK in text:
            return [plain(s) for s in self.cut.findall(MARK + text.replace(" ", MARK))]
        first, *others = text.split("\n")
        found = list(map(marked, first.split(" ")))
        feed = plain("\n") if others else None
        for line in others:
            start, *rest = line.split(" ")
            found.append(feed)
            if start:
                found.append(plain(start))
            found.extend(map(marked, rest))
        return found

    def code(self, texts: Sequence[str]) -> list[list[int]]:
        """The texts as numbers of spans, good until the next call; ``id_text`` and ``flat_ids`` tell what a span is."""
        if len(self.id_text) > SPANS_KEPT or self.chars > CHARS_KEPT:
            self._forget()
        found = [self._numbers(t) for t in texts]
        self._learn()
        return found

    def flat_ids(self, coded: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of coded texts one after the other, and where each text begins (and the end)."""
        number = np.fromiter(chain.from_iterable(coded), np.int64)
        first = self.bounds[number]
        bounds = np.concatenate([[0], np.cumsum(self.bounds[number + 1] - first)])
        at = np.repeat(first - bounds[:-1], np.diff(bounds)) + np.arange(bounds[-1])
        return self.ids[at], bounds[np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int64)]

    def encode(self, text: str) -> list[int]:
        return self.flat_ids(self.code([text]))[0].tolist()

    def pieces_text(self, ids) -> str:
        """Texts of pieces one after the other, runs of bytes read as UTF-8, marks as spaces."""
        ids = np.asarray(ids, np.int64)
        listed, runs = ids.tolist(), np.flatnonzero(self.in_run[ids])
        if not len(runs):
            return "".join(map(self.shown.__getitem__, listed))
        gaps = np.flatnonzero(np.diff(runs) > 1)
        starts, ends = runs[np.concatenate([[0], gaps + 1])].tolist(), runs[np.concatenate([gaps, [-1]])].tolist()
        out, at = [], 0
        for start, end in zip(starts, ends, strict=True):
            out += map(self.shown.__getitem__, listed[at:start])
            at = end + 1
            out.append(bytes_text(bytes(map(self.v.bytes_of.__getitem__, listed[start:at]))))
        out += map(self.shown.__getitem__, listed[at:])
        return "".join(out)

    def decode(self, ids) -> str:
        """The text of any id list; the space put before a text when encoding is taken off again."""
        text = self.pieces_text(ids)
        first = next((i for i in ids if self.v.texts[i] != ""), None)
        starts = first is not None and (self.v.texts[first] or "").startswith(MARK)
        return text[1:] if starts else text


def bytes_text(run: bytes | bytearray) -> str:
    """UTF-8 where whole characters are, one replacement character for each other byte."""
    raw, out, at = bytes(run), [], 0
    try:
        return raw.decode()
    except UnicodeDecodeError:
        pass
    while at < len(raw):
        lead = raw[at]
        size = 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0
        try:
            out.append(raw[at : at + size].decode() if size else "�")
            at += size or 1
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out)


_coders: dict[str, PieceCoder] = {}


def shared_coder(vocabulary: Vocabulary) -> PieceCoder:
    """The worker process's coder, kept with its tables from task to task."""
    if vocabulary.name not in _coders:
        _coders.clear()
        _coders[vocabulary.name] = PieceCoder(vocabulary)
    return _coders[vocabulary.name]


def id_lists(flat: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat))


def _shared(docs: DataFrame, model_path: str):
    return docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path))


def encode_texts(docs: DataFrame, model_path: str, into: str = "ids") -> DataFrame:
    """All rows and columns of ``docs`` plus the ids of ``text`` (array of int). A null text counts as empty: no ids.

    An input column that is called like ``into`` is replaced. Repeated rows are encoded alike, whatever a text's length.
    """
    shared = _shared(docs, model_path)
    docs = docs.drop(into)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared_coder(shared.value)
        for batch in batches:
            for rows, _, _ in chunks(batch, "text"):
                ids = id_lists(*coder.flat_ids(coder.code([t or "" for t in rows.column("text").to_pylist()])))
                yield pa.RecordBatch.from_arrays([*rows.columns, ids], [*rows.schema.names, into])

    return docs.mapInArrow(run, docs.select("*", F.lit(None).cast("array<int>").alias(into)).schema)


def decode_ids(rows: DataFrame, model_path: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """The other way: adds the text of an id array; a null array decodes to an empty text."""
    shared = _shared(rows, model_path)
    rows = rows.drop(into)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared_coder(shared.value)
        for batch in batches:
            texts = pa.array([coder.decode(x or []) for x in batch.column(ids).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, into])

    return rows.mapInArrow(run, rows.select("*", F.lit(None).cast("string").alias(into)).schema)


def encode_digests(docs: DataFrame, model_path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]): encode, then decode the ids, in one task; the ids leave it if wanted."""
    shared = _shared(docs, model_path)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared_coder(shared.value)
        for batch in batches:
            for rows, _, _ in chunks(batch, "text"):
                coded = coder.code([t or "" for t in rows.column("text").to_pylist()])
                flat, bounds = coder.flat_ids(coded)
                ids = [hashlib.sha256(",".join(map(coder.id_text.__getitem__, found)).encode()).hexdigest() for found in coded]
                cut = bounds.tolist()
                texts = [hashlib.sha256(coder.decode(flat[a:b]).encode()).hexdigest() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                more = [id_lists(flat, bounds)] if with_ids else []
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.diff(bounds).astype(np.int64)), pa.array(ids, pa.string()), pa.array(texts, pa.string()), *more], names)

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
