"""The decoded text comes from the ids: another table of pieces gives another text for the same ids."""

import dataclasses
import hashlib
import random

import public_tokenizers
import sentencepiece

from playrank.llm import pieces

MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))


def test_digests_decode_the_ids(make_docs, monkeypatch):
    real = pieces.Vocabulary.load(MODEL)
    upper = dataclasses.replace(real, texts=[t if t is None else t.upper() for t in real.texts], name="upper")
    texts = ["plain words of a text", " two  spaces\nand a line", "long" * 40, "a\x00\tb ▁ mark", "", None, "\n"]
    docs = make_docs(list(enumerate(texts)))
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    monkeypatch.setattr(pieces.Vocabulary, "load", staticmethod(lambda path: upper))
    rows = {r["doc_id"]: r for r in pieces.encode_digests(docs, MODEL, with_ids=True).collect()}
    for k, text in enumerate(texts):
        assert rows[k]["ids"] == library.encode(text or "")  # the same ids as ever
        assert rows[k]["decoded_sha256"] == hashlib.sha256(library.decode(rows[k]["ids"]).upper().encode()).hexdigest(), text


def test_runs_of_bytes_among_pieces_decode_like_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    coder, rng = pieces.PieceCoder(pieces.Vocabulary.load(MODEL)), random.Random(8)
    byte = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    whole = [[byte[b] for b in c.encode()] for c in "\n é中𐍈"]
    for _ in range(3000):
        ids = []
        for _ in range(rng.randrange(12)):
            kind = rng.random()
            ids += rng.choice(whole) if kind < 0.4 else [rng.choice(byte)] if kind < 0.7 else [rng.randrange(library.vocab_size())]
        assert coder.decode(ids) == library.decode(ids), ids
