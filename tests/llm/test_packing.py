import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from odd_rows import LONG, ODD
from tokenizers import Tokenizer

from playrank.llm.packing import Packer, pack_documents
from playrank.llm.queries import packing
from playrank.llm.token_ids import TokenIds

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as f:
        return TokenIds(f.read())


def document(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def test_ids_equal_the_library(encoder, library):
    rng = random.Random(1)
    parts = ["'", "'s", "'S", "'ll", "’s", "a", "Z", "É", "ß", "²", "½", "0", "7", "_", " ", "\x85", "\x1c", "\x00", "\t", "\n", "İ", "Σ", "Ⱥ", "中", "é", "😀", "×", "ƻ", "ǅ", "Ɓ", "<|endoftext|>", "..."]
    texts = ["".join(rng.choice(parts[: rng.choice([13, 32])]) for _ in range(rng.randrange(30))) for _ in range(4000)]
    texts += [f"{chr(c)}a{chr(c)}{chr(c)} b" for c in range(0x600)] + ["", LONG]
    assert encoder.by_word
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_words_are_learned_anew_when_forgotten(encoder, library, monkeypatch):
    import playrank.llm.token_ids as module

    monkeypatch.setattr(module, "KEPT", 3)
    monkeypatch.setattr(module, "WORDS_KEPT", 4)
    for text in ["one two three four", "five six", "one seven two"]:
        assert encoder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def greedy(lengths, m, capacity, linear, quadratic):
    """The dealing rule without numpy or a heap: sequences of (document, start, length)."""
    queue = [(-n, k, k, 0) for k, n in enumerate(lengths)]
    number = len(queue)
    rooms, costs, dealt = [capacity] * m, [0.0] * m, [[] for _ in range(m)]
    while any(rooms):
        queue.sort(key=lambda q: q[:2])
        size, _, doc, start = queue.pop(0)
        to = min((i for i in range(m) if rooms[i] >= -size), key=lambda i: (costs[i], i), default=None)
        if to is None:
            to = min((i for i in range(m) if rooms[i]), key=lambda i: (costs[i], i))
        n = min(-size, rooms[to])
        dealt[to].append((doc, start, n))
        rooms[to] -= n
        costs[to] += linear * n + quadratic * n * n
        if n < -size:
            queue.append((n + size, number, doc, start + n))
            number += 1
    return dealt


@pytest.mark.parametrize("seed", range(8))
def test_dealing_equals_the_plain_rule(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 3, 7, 40, rng.randrange(1, 64)]) for _ in range(rng.randrange(5, 120))]
    packer = Packer(0, 64, 10**6, 1.0, 0.01)
    for k, n in enumerate(lengths):
        packer.add(k, 0, np.arange(n, dtype=np.uint32), n)
    packer.fill()
    found = defaultdict(list)
    for doc, start, ids, total, sequence, offset in packer.rows:
        assert offset == sum(n for _, _, n in found[sequence]) and total == lengths[doc] and ids.tolist() == list(range(start, start + len(ids)))
        if len(ids) < 64:
            found[sequence].append((doc, start, len(ids)))
    short = [(k, n) for k, n in enumerate(lengths) if n < 64]
    m = sum(n for _, n in short) // 64
    plain = [[(short[d][0], s, n) for d, s, n in pieces] for pieces in greedy([n for _, n in short], m, 64, 1.0, 0.01)]
    assert [found[k] for k in sorted(found) if found[k]] == plain
    assert packer.held == sum(n for _, n in short) - 64 * m


def check(rows, texts, library, capacity):
    """Every id in exactly one piece, sequences gapless and full or a power of two; gives the ids of each document."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(bytes(r["tokens"]), "<u4").tolist()
        assert len(ids) == r["length"] > 0
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["start"], ids, r["doc_tokens"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == capacity or at & (at - 1) == 0 and at < capacity
    for doc, text in texts.items():
        want, found = document(library, text), []
        for start, ids, total in sorted(pieces.pop(doc)):
            assert start == len(found) and total == len(want)
            found += ids
        assert found == want
    assert not pieces
    return sequences


@pytest.mark.parametrize("tasks", [1, 7])
def test_every_id_is_packed_once(spark, make_docs, library, tasks):
    rng = random.Random(tasks)
    words = ["alpha", "beta", "gamma,", "delta", "ünïted", "x1"]
    texts = {k: " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 40, 300]))) for k in range(300)}
    texts[300], texts[301], texts[302] = LONG, "", None
    docs = make_docs(list(texts.items())).repartition(tasks)
    rows = pack_documents(docs, PATH, capacity=128, sequences=16).collect()
    sequences = check(rows, texts, library, 128)
    full = sum(sum(n for _, n in parts) == 128 for parts in sequences.values())
    assert len(sequences) - full <= 7  # one tail, whatever the number of tasks


def test_costs_come_near_each_other(make_docs):
    rng = random.Random(5)
    docs = make_docs([(k, " ".join(["word"] * rng.randrange(1, 100))) for k in range(2000)]).coalesce(1)
    rows = pack_documents(docs, PATH, capacity=256, sequences=64, linear=1.0, quadratic=1.0).collect()
    costs = defaultdict(float)
    for r in rows:
        costs[r["sequence_id"]] += r["length"] + r["length"] ** 2
    by_id = defaultdict(float)
    at = 0
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):  # the same pieces one after the other
        by_id[at // 256] += r["length"] + r["length"] ** 2
        at += r["length"]
    assert np.std(list(costs.values())) < 0.5 * np.std(list(by_id.values()))


def test_odd_rows(odd_docs, library):
    docs = odd_docs
    for name in ("tokens", "part", "start", "sequence_id", "offset", "__index_level_0__"):
        docs = docs.selectExpr("*", f"'clash' AS `{name}`")
    rows = pack_documents(docs, PATH).collect()
    assert rows[0].asDict().keys() == {"doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "tokens"}
    total = defaultdict(int)
    for r in rows:
        total[r["doc_id"]] += r["length"]
    want = defaultdict(int)
    for k, t in ODD:
        want[k] += len(document(library, t))
    assert total == want


def test_no_rows(no_docs):
    assert pack_documents(no_docs, PATH).collect() == []


def test_query_gives_digests_of_the_pieces(spark, tmp_path, make_docs, library):
    texts = {k: " ".join(["some words here"] * k) for k in range(40)} | {40: None}
    make_docs(list(texts.items())).write.parquet(str(tmp_path / "documents.parquet"))
    rows = packing(spark, str(tmp_path)).collect()
    pieces = {(r["doc_id"], r["start"]): r for r in rows}
    for k, text in texts.items():
        ids, at = np.array(document(library, text), "<u4"), 0
        while at < len(ids):
            r = pieces.pop((k, at))
            assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
    assert not pieces
