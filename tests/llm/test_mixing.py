import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from playrank.llm.mixing import hash_seed, mix_plan, mixed_documents, split_quotas


def resharing(sizes, weights, total, most):
    """Share, cap, share the excess again until none is above."""
    target, open_ones, left = dict.fromkeys(sizes, 0.0), set(sizes), total
    while open_ones and left > 1e-9:
        whole = sum(weights[s] for s in open_ones)
        for s in open_ones:
            target[s] += left * weights[s] / whole
        left = 0.0
        for s in list(open_ones):
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_ones.remove(s)
    return target


def corpus(n=300):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else [None, "é", "b", "B", "a", "z"][i % 6]
        rows.append((i, " ".join(["word"] * int(rng.integers(0, 80))), source))
    return rows


def taken(plan):
    return {r["doc_id"]: (r["source"], r["size"], r["target"], sum(d["words"] for d in r["draws"])) for r in plan.collect()}


def test_targets_follow_the_resharing_and_are_met(make_docs):
    rows = corpus()
    got = taken(mix_plan(make_docs(rows)))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target = resharing(sizes, weights, 1.5 * sum(sizes.values()), 2)
    for source in sizes:
        drawn = sum(v[3] for v in got.values() if v[0] == source)
        assert abs(drawn - target[source]) <= 0.5 + 1e-6
    for source, size, t, drawn in got.values():
        assert abs(t - target[source]) < 1e-6 and 0 <= drawn <= 2 * size


def test_reruns_agree_whatever_the_partitions(make_docs):
    docs = make_docs(corpus())
    key = lambda df: sorted((r["doc_id"], str(r["draws"])) for r in mix_plan(df).collect())
    assert key(docs) == key(docs.repartition(7)) == key(docs.coalesce(1))


def test_tree_keeps_margins():
    quotas = np.array([0, 1, 700, 33, 5])
    counts = split_quotas(quotas, 8, np.random.default_rng(0))
    assert (counts.sum(1) == quotas).all() and counts.sum(0).max() - counts.sum(0).min() <= 1 and (counts >= 0).all()
    mean = np.mean([split_quotas(quotas, 4, np.random.default_rng(k))[3] for k in range(400)], axis=0)
    assert np.allclose(mean, 33 / 4, atol=0.5)


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_mix(rows):
    """How often each (doc_id, text, source) row is drawn, whole, for rows without equal ids or with."""
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += words(t)
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    target = resharing(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}, 1.5 * sum(sizes.values()), 2)
    units = defaultdict(list)
    for d, t, s in rows:
        key = str(d) if d is not None else hashlib.md5((t or "").encode()).hexdigest() if t is not None else None
        units[s, hashlib.md5("|".join(x for x in ("mix", key) if x is not None).encode()).hexdigest()].append((d, t, s))
    times = Counter()
    for s, size in sizes.items():
        quota = math.floor(target[s] + 0.5)
        passes = min(quota // size, 2) if size else 0
        left = quota - passes * size
        for (source, _), unit in sorted(units.items(), key=lambda u: u[0][1]):
            if source == s:
                held = sum(words(t) for _, t, _ in unit)
                for row in unit:
                    if words(row[1]):
                        times[row] += passes + (left > 0 and 2 * left >= held)
                left -= held
    return +times


@pytest.mark.parametrize("n", [300, 40, 3])
def test_mixed_texts_are_whole_and_drawn_as_by_hand(make_docs, n):
    rows = corpus(n)
    docs = make_docs(rows)
    got = mixed_documents(docs).collect()
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in got) == plain_mix(rows)
    target = {r["source"]: r["target"] for r in mix_plan(docs).collect()}
    drawn, largest = Counter(), Counter()
    for r in got:
        drawn[r["source"]] += words(r["text"])
    for _, t, s in rows:
        largest[s] = max(largest[s], words(t))
    assert all(abs(drawn[s] - target[s]) <= largest[s] / 2 + 1 for s in target)


def test_columns_of_any_name_are_kept(make_docs):
    from pyspark.sql import functions as F

    rows = corpus(30)
    names = ["__size", "__row", "_size", "doc", "key", "h", "b", "bb", "s", "turn", "part", "last", "before", "words", "ends", "a.b"]
    docs = make_docs(rows).withColumns({c: F.lit(f"clash {c}") for c in names}).withColumn("_shard", F.lit("gone"))
    got = mixed_documents(docs, in_order=True)
    assert got.columns == [*make_docs(rows).columns, *names, "_shard", "_place"]
    kept = got.collect()
    assert kept and all(r[c] == f"clash {c}" for r in kept for c in names)
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in kept) == plain_mix(rows)


def test_odd_rows(odd_docs):
    from odd_rows import ODD

    rows = mix_plan(odd_docs).collect()
    assert len(rows) == len(ODD)
    assert all(0 <= sum(d["words"] for d in r["draws"]) <= 2 * r["size"] for r in rows)
    total, drawn = sum(r["size"] for r in rows), sum(d["words"] for r in rows for d in r["draws"])
    assert abs(drawn - 1.5 * total) <= 4


def test_empty_and_wordless_tables(no_docs, make_docs):
    assert mix_plan(no_docs).count() == 0 and mixed_documents(no_docs, in_order=True).count() == 0
    assert mixed_documents(make_docs([(1, None), (2, "")])).count() == 0
    assert [r["draws"] for r in mix_plan(make_docs([(1, None), (2, "")])).collect()] == [[], []]


def test_rows_that_share_an_id_or_have_none(odd_docs, make_docs):
    """Rows with one id are drawn together, never once per pair of rows; those without are told apart by their texts."""
    rows = [(7, "a b c d"), (7, "e f"), (7, "g h i"), *[(None, f"n{i} x{i} y{i}") for i in range(30)], *[(i, f"u{i} v{i}") for i in range(100, 130)]]
    rows = [(*r, f"src{i % 2}") for i, r in enumerate(rows)]
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in mixed_documents(make_docs(rows)).collect()) == plain_mix(rows)
    odd = [(r["doc_id"], r["text"], r["source"]) for r in odd_docs.collect()]
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in mixed_documents(odd_docs, in_order=True).collect()) == plain_mix(odd)


def test_blocks_are_dealt_as_the_tree_says(make_docs):
    """Sources with few blocks too; the mix comes shard by shard in shuffled order."""
    rows = [(i, "w " * (1 + i % 5), "few" if i < 7 else "some" if i < 60 else "many") for i in range(400)]
    docs = make_docs(rows)
    dealt, blocks = {}, {}
    for r in mix_plan(docs).collect():
        block = hashlib.md5(f"mix|{r['doc_id']}".encode()).hexdigest()[:2]
        blocks.setdefault(r["source"], set()).add(block)
        for d in r["draws"]:
            assert dealt.setdefault((r["source"], d["pass"], block), d["shard"]) == d["shard"]
    names = sorted(blocks)
    given = np.array([sum(1 for s, _, _ in dealt if s == name) for name in names])
    counts = np.zeros((len(names), 8), int)
    for (s, _, _), shard in dealt.items():
        counts[names.index(s), shard] += 1
    assert (counts == split_quotas(given, 8, np.random.default_rng(hash_seed("mix")))).all()
    assert counts.sum(0).max() - counts.sum(0).min() <= 1

    order = [(r["_shard"], r["_place"]) for r in mixed_documents(docs, in_order=True).collect()]
    assert order == sorted(order) and len({s for s, _ in order}) == 8


def test_shards_of_several_partitions_stay_in_order(make_docs, monkeypatch):
    import playrank.llm.mixing as module

    docs = make_docs(corpus(200))
    monkeypatch.setattr(module, "WORDS_PER_PART", 300)
    mixed = mixed_documents(docs, in_order=True)
    assert mixed.rdd.getNumPartitions() > 16
    order = [(r["_shard"], r["_place"]) for r in mixed.collect()]
    assert order == sorted(order)
