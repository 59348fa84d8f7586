import random
import re

import numpy as np
import pytest

from playrank.llm.set_join import jaccard_components, linked_rows, parity_bits, prefix_length, wanted_overlap

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    ws = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(ws) >= size:
        return {tuple(ws[i : i + size]) for i in range(len(ws) - size + 1)}
    return {tuple(ws)} if ws else set()


def brute(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def near_copies(seed, groups=6, copies=40):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    rows = []
    for g in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 25, 60, 120]))]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                words += [rng.choice(vocabulary) for _ in range(rng.randrange(1, 6))]
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (2, 50)])
def test_against_all_pairs(make_docs, size, percent):
    rows = near_copies(size)
    got = jaccard_components(make_docs(rows), size, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, size, percent)


def test_groups_dealt_over_blocks(make_docs, monkeypatch):
    """A group larger than a block is compared block by block and nothing is lost."""
    import playrank.llm.set_join as module

    monkeypatch.setattr(module, "BLOCK_SETS", 16)
    monkeypatch.setattr(module, "LIST_BLOCK", 4)
    rows = near_copies(11, groups=2, copies=120)
    assert sorted(map(tuple, jaccard_components(make_docs(rows), 3, 90).collect()), key=str) == brute(rows, 3, 90)


def test_odd_rows(odd_docs):
    from odd_rows import ODD

    got = sorted(map(tuple, jaccard_components(odd_docs, 3, 90).collect()), key=str)
    assert got == brute(ODD, 3, 90)


def test_empty_table(no_docs):
    assert jaccard_components(no_docs).count() == 0


def test_derived_answers_equal_counted_ones():
    rng = np.random.default_rng(5)
    for _ in range(30):
        leader = np.unique(rng.integers(0, 200, 60).astype(np.uint64))
        sets = [leader]
        for _ in range(12):
            kept = leader[rng.random(len(leader)) < rng.choice([0.8, 0.95, 1.0])]
            sets.append(np.unique(np.concatenate([kept, rng.integers(200, 230, rng.integers(0, 6)).astype(np.uint64)])))
        label = linked_rows(sets, leader, 80)
        linked = np.array([[100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)) for b in sets] for a in sets])
        expected = np.arange(len(sets))
        for _ in sets:
            expected = np.array([expected[row].min() for row in linked])
        assert (label == expected).all()


def test_bounds():
    for n in range(1, 200):
        for percent in (50, 80, 90, 100):
            assert n - prefix_length(n, percent) + 1 >= percent * n / 100 > n - prefix_length(n, percent)
    assert wanted_overlap(10, 10, 90) == 10 and wanted_overlap(19, 19, 90) == 18
    a, b = np.arange(100, dtype=np.uint64), np.arange(5, 103, dtype=np.uint64)
    x, y = (np.unpackbits(np.frombuffer(parity_bits(s), np.uint8)) for s in (a, b))
    assert (x != y).sum() <= 8


@pytest.mark.parametrize("bad", [(0, 90), (3, 0), (3, 101)])
def test_refuses_bad_parameters(no_docs, bad):
    with pytest.raises(ValueError, match="size"):
        jaccard_components(no_docs, *bad)
