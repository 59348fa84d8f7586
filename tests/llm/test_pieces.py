import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from playrank.llm.pieces import PieceCoder, Vocabulary, decode_ids, encode_digests, encode_texts

MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def coder():
    return PieceCoder(Vocabulary.load(MODEL))


def fuzz(n):
    rng = random.Random(7)
    parts = ["a", "th", "e", " ", "  ", "\n", "▁", "é", "ß", "中", "𐍈", "\x00", "<s>", "<0x0A>", "<unk>", "!", "\t", "ing", "aaaa", "==", "​", "ﬁ", "é", "\r\n", " world"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(n)]
    texts += ["".join(rng.choice("aeiotns rhl") for _ in range(rng.randrange(40))) for _ in range(n)]
    return texts + [c * k for c in "a =-" for k in range(70)]


def test_equals_the_library(coder, library):
    for text in fuzz(3000):
        ids = library.encode(text)
        assert coder.encode(text) == ids, text
        assert coder.decode(ids) == library.decode(ids), text


def test_spans_coded_together_equal_spans_coded_alone(coder):
    """Single characters, one piece, the longest that go together, and many of one length."""
    rng = random.Random(9)
    known = sorted(coder.single)
    spans = ["".join(rng.choice(known) for _ in range(rng.choice([1, 2, 5, 17, 64]))) for _ in range(600)]
    spans += ["".join(rng.choice("aeiotns▁") for _ in range(rng.randrange(1, 64))) for _ in range(600)] + ["▁", "aaaa" * 16, "▁the"]
    flat, bounds = coder.encode_spans(spans)
    assert [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [coder.encode_span(s) for s in spans]


def test_spans_are_forgotten_and_coded_anew(library, monkeypatch):
    import playrank.llm.pieces as module

    monkeypatch.setattr(module, "SPANS_KEPT", 5)
    small = PieceCoder(Vocabulary.load(MODEL))
    for text in fuzz(60):
        assert small.encode(text) == library.encode(text), text
    texts = fuzz(40)
    flat, bounds = small.flat_ids(small.code(texts))
    assert [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [library.encode(t) for t in texts]


def test_number_tables_hold_what_was_put():
    from playrank.llm.pieces import _Numbers

    rng = random.Random(4)
    table, held = _Numbers(3), {}
    for _ in range(30):
        new = {rng.randrange(1 << 40) for _ in range(50)} - set(held)
        held.update({k: rng.randrange(1 << 30) for k in new})
        table.put(np.array(sorted(new), np.int64), np.array([held[k] for k in sorted(new)], np.int32))
        asked = np.array([*held, *(rng.randrange(1 << 40) for _ in range(50))], np.int64)
        assert table.get(asked).tolist() == [held.get(k, -1) for k in asked.tolist()]


def test_decodes_any_ids_like_the_library(coder, library):
    rng = random.Random(3)
    for _ in range(2000):
        ids = [rng.randrange(32_000) if rng.random() < 0.6 else rng.randrange(3, 259) for _ in range(8)]
        assert coder.decode(ids) == library.decode(ids), ids


def test_pair_test_equals_merging(coder):
    """Two pieces fit exactly if merging their joined text gives them back."""
    rng = random.Random(1)
    ids, order = coder.v.ids, coder.v.order
    pieces = [p for p in ids if len(p) <= 6]
    for _ in range(4000):
        a, b = rng.choice(pieces), rng.choice(pieces)
        parts = list(a + b)
        while True:
            best = min(((order[ids[x + y]], k) for k, (x, y) in enumerate(zip(parts, parts[1:], strict=False)) if x + y in ids), default=None)
            if best is None:
                break
            k = best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        assert coder.fits(ids[a], ids[b]) == (parts == [a, b]), (a, b)


def test_tables(odd_docs, library):
    from odd_rows import ODD

    coded = encode_texts(odd_docs, MODEL)
    assert coded.columns == [*odd_docs.columns, "ids"]
    rows = coded.collect()
    assert sorted(((r["doc_id"], r["ids"]) for r in rows), key=str) == sorted(((d, library.encode(t or "")) for d, t in ODD), key=str)
    back = decode_ids(coded, MODEL, into="again").collect()
    assert all(r["again"] == library.decode(r["ids"]) for r in back)
    for r in encode_digests(odd_docs, MODEL, with_ids=True).collect():
        assert r["n_tokens"] == len(r["ids"])
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, r["ids"])).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(r["ids"]).encode()).hexdigest()


def test_query_equals_the_library(spark, library):
    from playrank.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op5_pieces"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_empty_table(no_docs):
    assert encode_digests(no_docs, MODEL).count() == 0 and encode_texts(no_docs, MODEL).count() == 0
