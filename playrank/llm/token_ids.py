"""Token ids of whole texts from a public ``tokenizers`` vocabulary, with tables of what is known already.

The vocabulary is one that lower-cases, drops white space and encodes every word on its own, marking the last token of a
word. A word's ids are therefore the same wherever it stands, and they are asked from the library once per process:
new words go to it together, joined by spaces, and are told apart by the mark of their last tokens. Stretches between
white space (a word with its punctuation, say) are cut into words once and then known as a whole.

Only texts over plain Latin characters take that way, where the library's normalising and cutting is a fixed pattern.
Any other text is handed to the library whole, so all ids are the library's.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from itertools import chain

import numpy as np

KEPT = 400_000  # stretches known per process
WORDS_KEPT = 600_000  # words, which are dearer to ask for
WORD_END = "</w>"

# The pattern that the vocabulary file cuts words by, over lower-cased characters below U+02B0.
_LETTERS = "a-zªµºß-öø-ʯ"
_NUMBERS = "0-9²³¹¼-¾"
_SPACES = "\\t-\\r \u0085 "
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+")
# Characters of a text that the pattern may be used for: no capitals that lower-casing takes out of its range, and no
# separators that count as space here but not in the library.
_OTHER = re.compile("[^\x00-\x1b\x20-\u012f\u0131-\u0239\u023b-\u023d\u023f-\u024f]")
FILE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class _Known(dict):
    """Numbers for strings in the order they are first asked for, and the ids of each."""

    def __init__(self) -> None:
        self.new: list[str] = []
        self.ids = np.empty(0, np.uint32)
        self.starts = np.zeros(1, np.int64)  # where each string's ids begin, and the end

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        self.new.append(key)
        return number

    def numbers(self, keys: list[str]) -> tuple[np.ndarray, list[str]]:
        """The keys' numbers, and the keys whose ids must be given now by ``learn``."""
        found = np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))
        new, self.new = self.new, []
        return found, new

    def learn(self, ids: np.ndarray, stops: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.ids) + stops])
        self.ids = np.concatenate([self.ids, ids])

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all strings one after the other, and where each begins (and the end)."""
        first = self.starts[numbers]
        bounds = np.zeros(len(numbers) + 1, np.int64)
        np.cumsum(self.starts[numbers + 1] - first, out=bounds[1:])
        at = np.repeat(first - bounds[:-1], np.diff(bounds))
        at += np.arange(bounds[-1])
        return self.ids[at], bounds


def _per_group(bounds: np.ndarray, counts: list[int]) -> np.ndarray:
    """Bounds of groups of ``counts`` neighbouring entries each."""
    return bounds[np.concatenate([[0], np.cumsum(np.array(counts, np.int64))])]


class TokenIds:
    """Encoder over the JSON text of a vocabulary file. Strings of special tokens inside a text are ordinary text."""

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary)
        self.library.encode_special_tokens = True
        self.by_word = _cuts_words(json.loads(vocabulary))
        self.ends = np.zeros(self.library.get_vocab_size(), bool)
        for piece, i in self.library.get_vocab().items():
            self.ends[i] = piece.endswith(WORD_END)
        self.words, self.stretches = _Known(), _Known()

    def _learn_words(self, words: list[str]) -> None:
        ids = np.array(self.library.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.uint32)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words):
            raise RuntimeError("the vocabulary joins or splits words")
        self.words.learn(ids, stops)

    def _learn_stretches(self, stretches: list[str]) -> None:
        parts = [_WORDS.findall(s) for s in stretches]
        numbers, new = self.words.numbers(list(chain.from_iterable(parts)))
        if new:
            self._learn_words(new)
        ids, bounds = self.words.gather(numbers)
        self.stretches.learn(ids, _per_group(bounds, [len(p) for p in parts])[1:])

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids (uint32) of every text."""
        result: list[np.ndarray | None] = [None] * len(texts)
        plain = [k for k, t in enumerate(texts) if self.by_word and not _OTHER.search(t)]
        whole = sorted(set(range(len(texts))) - set(plain))
        for k, e in zip(whole, self.library.encode_batch_fast([texts[k] for k in whole], add_special_tokens=False), strict=True):
            result[k] = np.array(e.ids, np.uint32)
        if len(self.stretches) > KEPT:
            self.stretches = _Known()
        if len(self.words) > WORDS_KEPT:
            self.words = _Known()
        parts = [texts[k].lower().split() for k in plain]
        numbers, new = self.stretches.numbers(list(chain.from_iterable(parts)))
        if new:
            self._learn_stretches(new)
        ids, bounds = self.stretches.gather(numbers)
        bounds = _per_group(bounds, [len(p) for p in parts])
        for k, a, b in zip(plain, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            result[k] = ids[a:b]
        return result


def _cuts_words(described: dict) -> bool:
    """Whether the file normalises and cuts as the word pattern here does."""
    before = [n.get("type") for n in (described.get("normalizer") or {}).get("normalizers", [])]
    cuts = (described.get("pre_tokenizer") or {}).get("pretokenizers", [])
    patterns = [c.get("pattern", {}).get("Regex") for c in cuts if c.get("type") == "Split"]
    return before == ["NFC", "Replace", "Lowercase"] and patterns == [FILE_PATTERN] and described["model"].get("end_of_word_suffix") == WORD_END


_encoders: dict[int, TokenIds] = {}


def shared_encoder(vocabulary: str) -> TokenIds:
    """One encoder per worker process, kept from task to task."""
    key = hash(vocabulary)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = TokenIds(vocabulary)
    return _encoders[key]
