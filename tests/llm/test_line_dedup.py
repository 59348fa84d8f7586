import random
import re

import pytest

from playrank.llm.line_dedup import dedup_lines

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, min_words):
    """Longest run at every line that starts earlier too; deleted if it has words enough."""
    docs = {}
    for doc, text in rows:
        if text is not None:
            docs.setdefault((doc is None, doc, text), text.split("\n"))
    keyed = []
    for key, ls in sorted(docs.items(), key=lambda x: (x[0][0], x[0][1] or 0, x[0][2])):
        keyed.append((key, [(i, x, len(WORD.findall(x))) for i, x in enumerate(ls) if WORD.search(x)], ls))
    places = [(d, p) for d, (_, seq, _) in enumerate(keyed) for p in range(len(seq))]
    gone = {k: set() for k in docs}
    for at, (d, p) in enumerate(places):
        seq = keyed[d][1]
        best = 0
        for e, q in places[:at]:
            other, n = keyed[e][1], 0
            while p + n < len(seq) and q + n < len(other) and seq[p + n][1] == other[q + n][1]:
                n += 1
            best = max(best, n)
        if best and sum(x[2] for x in seq[p : p + best]) >= min_words:
            gone[keyed[d][0]].update(x[0] for x in seq[p : p + best])
    for key, seq, _ in keyed:  # blank lines between deleted ones
        for (a, _, _), (b, _, _) in zip(seq, seq[1:], strict=False):
            if a in gone[key] and b in gone[key]:
                gone[key].update(range(a, b))
    result = []
    for doc, text in rows:
        key = (doc is None, doc, text)
        result.append((doc, None if text is None else "\n".join(x for i, x in enumerate(docs[key]) if i not in gone[key])))
    return sorted(result, key=str)


def texts(seed, n=40):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(rng.choice([1, 2, 3, 9]))) for _ in range(12)]
    passages = [[rng.choice(pool) for _ in range(rng.randrange(1, 7))] for _ in range(5)]
    rows = []
    for i in range(n):
        ls = []
        for _ in range(rng.randrange(1, 6)):
            ls += rng.choice(passages) if rng.random() < 0.6 else [rng.choice([*pool, "", "  "])]
            if rng.random() < 0.3:
                ls.append(f"own line {i} {rng.random()}")
        rows.append((i, "\n".join(ls)))
    return rows


@pytest.mark.parametrize("min_words", [1, 5, 12, 40])
def test_against_brute_force(make_docs, min_words):
    rows = texts(min_words)
    rng = random.Random(1)
    rng.shuffle(rows)
    got = dedup_lines(make_docs(rows), min_words)
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == brute(rows, min_words)


def test_a_repeated_line_in_one_text(make_docs):
    got = dedup_lines(make_docs([(1, "a b\na b\na b\nc")]), 2).first()
    assert got["text"] == "a b\nc" and [tuple(r) for r in got["_deleted"]] == [(1, 2)]


def test_a_long_passage_goes_and_short_common_lines_stay(make_docs):
    passage = " ".join(f"p{i}" for i in range(55))
    rows = [(i, f"title {i}\n{passage}\ncommon footer line\nbody {i}") for i in range(5)]
    got = {r["doc_id"]: r["text"] for r in dedup_lines(make_docs(rows), 50).collect()}
    assert got[0] == rows[0][1]
    assert all(got[i] == f"title {i}\nbody {i}" for i in range(1, 5))  # the footer is part of the repeated run
    alone = dedup_lines(make_docs([(i, f"own words {i}\ncommon footer line\nmore {i}") for i in range(5)]), 50)
    assert all(r["_deleted"] is None for r in alone.collect())


def test_odd_rows(odd_docs):
    from odd_rows import ODD

    got = dedup_lines(odd_docs, 5)
    assert got.columns == [*odd_docs.columns, "_deleted"]
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == brute(ODD, 5)


def test_empty_table(no_docs):
    assert dedup_lines(no_docs).count() == 0


def test_rows_without_an_id_are_documents_of_their_own(make_docs):
    passage = " ".join(f"p{i}" for i in range(60))
    got = sorted(r["text"] for r in dedup_lines(make_docs([(None, passage), (None, passage), (3, f"x\n{passage}")]), 50).collect())
    assert got == ["", "", f"x\n{passage}"]
    alone = sorted(r["text"] for r in dedup_lines(make_docs([(None, passage)] * 3), 50).collect())
    assert alone == ["", "", passage]


def test_columns_of_any_name_are_kept(make_docs):
    from pyspark.sql import functions as F

    rows = texts(4)
    names = ["__d", "__cut", "__row", "__block", "__bits", "d", "doc", "cut", "r", "n", "a.b"]
    docs = make_docs(rows).withColumns({c: F.lit(f"clash {c}") for c in names}).withColumn("_deleted", F.lit("gone"))
    got = dedup_lines(docs, 5)
    assert got.columns == [*make_docs(rows).columns, *names, "_deleted"]
    kept = got.collect()
    assert all(r[c] == f"clash {c}" for r in kept for c in names)
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == brute(rows, 5)


def test_hot_lines_take_the_broadcast_way(make_docs, monkeypatch):
    import playrank.llm.runs as module

    rows = [(i, "\n".join([f"own {i}", *[f"line {k} of many" for k in range(6)], "the common line"])) for i in range(80)]
    monkeypatch.setattr(module, "HOT", 20)
    assert sorted(((r["doc_id"], r["text"]) for r in dedup_lines(make_docs(rows), 8).collect()), key=str) == brute(rows, 8)
