import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from playrank.llm.language_model import CLASS_WORDS, CLASSES, RARE, Tables, count_tokens, held_out, lexicon, score_texts, tokens, train

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def split(text):
    return [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def brute(rows):
    counts = collections.Counter()
    for doc, text in rows:
        if doc is None or zlib.crc32(str(doc).encode()) % 5 != 1:
            counts.update(split(text))
    n, v = sum(counts.values()), len(counts)
    result = []
    for doc, text in rows:
        words = split(text)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        out = doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1
        result.append((doc, out, len(words), sum(counts[w] > 0 for w in words), n, round(base, 4)))
    return sorted(result, key=str)


def chain(n=400):
    """Texts whose next word mostly follows from the last one."""
    rng = random.Random(5)
    follow = {i: [rng.randrange(60) for _ in range(3)] for i in range(60)}
    rows = []
    for i in range(n):
        at, words = rng.randrange(60), []
        for _ in range(rng.randrange(5, 60)):
            words.append(f"w{at}" if rng.random() < 0.9 else f"rare{rng.randrange(10_000)}.")
            at = rng.choice(follow[at])
        rows.append((i, " ".join(words)))
    return rows


def values(df):
    return sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in df.collect()), key=str)


@pytest.mark.parametrize("head_limit", [1 << 19, 50, 0])
def test_base_against_brute_force(make_docs, head_limit):
    """The same with all counts broadcast, some, or none."""
    rows = chain(120)
    assert values(score_texts(make_docs(rows), head_limit)) == brute(rows)


def test_model_beats_the_unigram_on_held_out_texts(make_docs):
    scored = [r for r in score_texts(make_docs(chain(1500))).collect() if r["held_out"]]
    base, model, n = (sum(r[c] for r in scored) for c in ("base_score", "score", "n_tokens"))
    assert len(scored) > 100 and model > base + 0.1 * n


def test_model_follows_from_the_data_alone(make_docs):
    """Several rounds, whatever the splits; later rounds go on from earlier ones and gain from more texts."""
    texts = make_docs(chain(1500)).select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    known = lexicon(count_tokens(texts))
    one, other = (train(df, known, 40_000) for df in (texts.coalesce(1), texts.repartition(11)))
    assert all(np.array_equal(x, y) for x, y in zip(one.all(), other.all(), strict=True))
    few = train(texts.where("doc_id < 100"), known, 40_000)
    assert np.abs(one.class_tables[0]).sum() > 1.2 * np.abs(few.class_tables[0]).sum()


def test_probabilities_sum_to_one(make_docs, spark):
    from pyspark.sql import functions as F

    texts = make_docs(chain(60)).select("text", held_out(F.col("doc_id")).alias("held_out"))
    counts = count_tokens(texts)
    known = lexicon(counts)
    model = Tables(known)
    rng = np.random.default_rng(0)
    for t in model.all():
        t += rng.normal(0, 0.3, t.shape).astype(np.float32)
    text = np.frombuffer(b"w1 w2 w3", np.uint8)
    hashes, kinds, begun = tokens(text, np.array([0, len(text)]))
    total = 0.0
    for row in counts.collect():  # every known word as the third
        h, k = hashes.copy(), kinds.copy()
        h[2], k[2] = row["token"], row["kind"]
        logs, frequent = model.log10(h, k, begun)
        total += 10 ** logs[2] * (1 if frequent[2] else (row["c"] + 0.5) / known.rare_mass[row["kind"]])
    h, k = hashes.copy(), kinds.copy()
    h[2] = 12345  # an unknown word of every kind has the rest
    for kind in range(RARE):
        k[2] = kind
        total += 10 ** model.log10(h, k, begun)[0][2] * 0.5 / known.rare_mass[kind]
    used = known.word_bias.reshape(CLASSES, CLASS_WORDS)
    empty = sum(np.exp(used[c][len(known.model) - c * CLASS_WORDS :]).sum() > 0 for c in range(CLASSES) if len(known.model) < (c + 1) * CLASS_WORDS)
    assert total <= 1 + 1e-4 and (total > 0.9 or empty)


def test_equal_tokens_share_a_rare_class(make_docs):
    """Words in capitals too: a word's class holds its count whatever its case."""
    text = "HEADING Heading heading É. é. NO, no, X x 7"
    data = np.frombuffer(text.encode(), np.uint8)
    hashes, kinds, _ = tokens(data, np.array([0, len(data)]))
    assert len(set(zip(hashes.tolist(), kinds.tolist(), strict=True))) == len(set(hashes.tolist()))

    texts = make_docs([(2, " ".join(f"w{i}x W{i}X" for i in range(2000)))]).select("text", held_out(F.col("doc_id")).alias("held_out"))
    known = lexicon(count_tokens(texts))
    data = np.frombuffer(" ".join(f"W{i}X" for i in range(2000)).encode(), np.uint8)
    hashes, kinds, _ = tokens(data, np.array([0, len(data)]))
    rare = known.model_id(hashes[:-1]) < 0
    share = 2.5 / known.rare_mass[kinds[:-1][rare]]
    assert rare.any() and share.sum() < 1


def test_odd_rows(odd_docs):
    from odd_rows import ODD

    got = score_texts(odd_docs)
    assert values(got) == brute(ODD)
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got.collect())


def test_nothing_to_learn_from(make_docs, no_docs):
    assert score_texts(no_docs).count() == 0
    out = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = score_texts(make_docs([(out, "a b")])).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (3, 0, 0)
    assert abs(row["base_score"]) < 1e-9 and np.isfinite(row["score"])  # one unknown word holds all
