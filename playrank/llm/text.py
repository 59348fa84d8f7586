"""Words, lines and 64-bit hashes of whole Arrow text batches, on bytes, without a Python loop per word.

White space is ``[\\x20\\x09-\\x0D]``. All of it is ASCII, so byte positions split UTF-8 safely.
Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # texts looked at together inside a task; one longer text is one chunk

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256)
LOWER[ord("A") : ord("Z") + 1] += 32
_RANDOM = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_CASED, _LOWERED = _RANDOM, _RANDOM[LOWER]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64; kept and grown as needed."""
    table = _powers.get(base)
    if table is None or len(table) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        steps[0] = 1
        table = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return table[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hash of each byte span: equal spans get equal values, wherever they stand."""
    n = len(data)
    terms = (_LOWERED if lower else _CASED)[data] * _power_table(_BASE, n)
    before = np.zeros(n + 1, np.uint64)
    np.cumsum(terms, out=before[1:])
    value = (before[ends] - before[starts]) * _power_table(_INVERSE, n + 1)[starts]
    return mix(value + (ends - starts).astype(np.uint64))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and where each begins (one more at the end)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with at most ``limit`` bytes of text each (one text at least)."""
    if not batch.num_rows:
        return
    data, offsets = text_buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        stop = min(stop, batch.num_rows)
        yield batch.slice(at, stop - at), data[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at]
        at = stop


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the first word number of each text (one more at the end).

    ``space`` tells for each byte whether it stands between words.
    """
    inside = ~space[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    filled = offsets[1:] > offsets[:-1]
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    opens[first] = inside[first]
    closes[last] = inside[last]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every ``\\n``-split line, and the first line number of each text.

    Like a split, a text has one line more than it has line feeds; an empty text has one empty line.
    """
    feeds = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable")
    ends = np.sort(np.concatenate([offsets[1:], feeds]), kind="stable")
    per_text = np.searchsorted(feeds, offsets[1:]) - np.searchsorted(feeds, offsets[:-1]) + 1
    return starts, ends, np.concatenate([[0], np.cumsum(per_text)])


def signed(values: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's bigint."""
    return values.view(np.int64)


def _whole_sequence(word: np.ndarray) -> np.ndarray:
    """One hash for a text shorter than a shingle; its length tells it from longer runs."""
    value = np.full(1, len(word), np.uint64)
    for k in range(len(word)):
        value = mix(value * np.uint64(0xD6E8FEB86659FD93) + word[k : k + 1])
    return value


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int, lower: bool = True) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's word runs of the given size.

    A text with fewer words has its whole sequence as its only element; one without words has none.
    """
    starts, ends, first = words(data, offsets)
    word = span_hashes(data, starts, ends, lower)
    n = len(word)
    run = np.zeros(max(0, n - size + 1), np.uint64)
    for k in range(size):
        run = run * np.uint64(0xD6E8FEB86659FD93) + word[k : n - size + 1 + k]
    run = mix(run)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            sets.append(np.unique(run[a : b - size + 1]))
        elif b > a:
            sets.append(_whole_sequence(word[a:b]))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets
