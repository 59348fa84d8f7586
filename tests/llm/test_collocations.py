import random
import re
from collections import Counter, defaultdict

import pytest
from odd_rows import ODD
from pyspark.sql import functions as F

from playrank.llm.collocations import mine_phrases, phrase_paths, score_phrases

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER))]


def counts(rows, longest=4):
    found = defaultdict(Counter)
    for lang, text in rows:
        for ws in pieces(text):
            for m in range(1, longest + 1):
                found[lang or "und"].update(tuple(ws[i : i + m]) for i in range(len(ws) - m + 1))
    return {lang: c for lang, c in found.items() if c}


def plain(rows, min_count, top=2000, cover=80):
    result = []
    for lang, f in counts(rows).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        often = {p: c for p, c in f.items() if len(p) > 1 and c >= min_count}
        held = {p for q, c in often.items() for m in range(2, len(q)) for i in range(len(q) - m + 1) for p in [q[i : i + m]] if 100 * c >= cover * f[p]}
        scored = []
        for p, a in often.items():
            if p not in held:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(result)


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def mined(spark, rows, min_count, **options):
    return mine_phrases(spark.createDataFrame(rows, "lang string, text string").repartition(5), min_count=min_count, **options)


def corpus(seed, n=250):
    rng = random.Random(seed)
    words = ["of", "The", "the", "a", "New", "york", "état", "x\x00y", "中文", "fox"]
    fixed = ["new york city hall is big", "the quick brown fox jumps over the lazy dog", "a  a a a a a"]
    rows = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else " ".join(rng.choices(words, weights=range(10, 0, -1), k=rng.randrange(0, 9))) for _ in range(rng.randrange(1, 6))]
        rows.append((rng.choice(["en", "de", None, "und"]), rng.choice([" ", ". ", "\t", ",", "\n", ""]).join(parts)))
    return rows


@pytest.mark.parametrize(("seed", "min_count", "top"), [(1, 3, 2000), (2, 12, 25), (3, 1, 2000)])
def test_against_plain_counting(spark, seed, min_count, top):
    rows = corpus(seed)
    got = score_phrases(mined(spark, rows, min_count), top=top).select(*COLUMNS).collect()
    assert sorted(tuple(r) for r in got) == plain(rows, min_count, top)


def test_runs_hold_exact_counts(spark):
    rows = corpus(7)
    result = mined(spark, rows, 4)
    want = {(lang, " ".join(p), c) for lang, f in counts(rows).items() for p, c in f.items() if c >= 4}
    assert {(r["lang"], r["phrase"], r["f"]) for r in result.runs.collect()} == want
    assert {(r["lang"], r["n"]) for r in result.words.collect()} == {(lang, sum(c for p, c in f.items() if len(p) == 1)) for lang, f in counts(rows).items()}


def test_full_bitmap_changes_nothing(spark, monkeypatch):
    """A bitmap too small for its pairs lets needless edges in and takes none away."""
    import numpy as np

    import playrank.llm.collocations as module

    rows = corpus(4)
    monkeypatch.setattr(module, "frequent_pairs", lambda docs, min_count: (np.full(1 << 13, 255, np.uint8), 16))
    got = score_phrases(mined(spark, rows, 3)).select(*COLUMNS).collect()
    assert sorted(tuple(r) for r in got) == plain(rows, 3)


def test_small_chunks_give_the_same(spark, make_docs, monkeypatch):
    import playrank.llm.collocations as module

    rows = corpus(5)
    whole = sorted(map(tuple, score_phrases(mined(spark, rows, 3)).collect()))
    monkeypatch.setattr(module, "CHUNK", 40)
    assert sorted(map(tuple, score_phrases(mined(spark, rows, 3)).collect())) == whole


def test_paths_are_whole_fixed_phrases(spark):
    """Unary paths of the graph: every repeated passage comes back as one phrase."""
    passage = "once upon a time there lived an old king in a very far country"
    rows = [("en", f"{passage}. {chr(97 + k)} b c d e")[:2] for k in range(6)] + [("de", "drei vier fünf sechs sieben")] * 5
    paths = {(r["lang"], r["phrase"], r["words"], r["f"]) for r in phrase_paths(mined(spark, rows, 5)).collect()}
    assert paths == {("en", passage, 14, 6), ("en", "b c d e", 4, 6), ("de", "drei vier fünf sechs sieben", 5, 5)}


@pytest.mark.parametrize("seed", [1, 6])
def test_paths_hold_every_edge_once(spark, seed):
    rows = corpus(seed)
    result = mined(spark, rows, 3)
    edges = Counter()
    f = counts(rows)
    ins, outs = defaultdict(list), defaultdict(list)
    for lang, c in f.items():
        for p, n in c.items():
            if len(p) == 4 and n >= 3:
                outs[lang, p[:3]].append(p)
                ins[lang, p[1:]].append(p)
    for r in phrase_paths(result).collect():
        ws = r["phrase"].split(" ")
        assert r["words"] == len(ws)
        for i in range(len(ws) - 3):
            p = tuple(ws[i : i + 4])
            edges[r["lang"], p] += 1
            assert f[r["lang"]][p] == r["f"]
            if i:  # an inner node: one way in and one way out, with all of its flow
                node = r["lang"], p[:3]
                assert len(ins[node]) == len(outs[node]) == 1 and f[r["lang"]][p[:3]] == r["f"]
    assert edges == {(lang, p): 1 for lang, c in f.items() for p, n in c.items() if len(p) == 4 and n >= 3}


def test_odd_rows(odd_docs):
    docs = odd_docs.withColumn("lang", F.when(F.col("doc_id") < 6, F.lit(None)).otherwise(F.col("lang")))
    for name in ("phrase", "pair", "c", "f", "k", "l", "rank", "__row"):
        docs = docs.withColumn(name, F.lit("clash"))
    rows = [(None if k is not None and k < 6 else "en", t) for k, t in ODD]
    got = score_phrases(mine_phrases(docs, min_count=2)).select(*COLUMNS).collect()
    assert sorted(tuple(r) for r in got) == plain(rows, 2)


def test_no_rows(no_docs):
    result = mine_phrases(no_docs)
    assert score_phrases(result).collect() == [] and phrase_paths(result).collect() == [] and result.words.collect() == []


def test_products_beyond_64_bits(spark):
    from playrank.llm.collocations import Phrases

    big = 5 * 10**17
    runs = [("en", 2, "a b", big, None, False), ("en", 1, "a", big + 1, big, False), ("en", 1, "b", 2 * big, big, False)]
    table = spark.createDataFrame(runs, "lang string, words int, phrase string, f bigint, covered bigint, unary boolean")
    total = spark.createDataFrame([("en", 9 * 10**17)], "lang string, n bigint")
    (row,) = score_phrases(Phrases(total, table, 4, 80)).collect()
    assert (row["a"], row["l"], row["r"], row["score"]) == (big, big + 1, 2 * big, 2_000_000 * big // (3 * big + 1))
