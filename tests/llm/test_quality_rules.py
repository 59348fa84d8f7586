import random
import re

import pytest
from pyspark.sql import functions as F

from playrank.llm.quality_rules import RuleConfig, base_failed, decision_list, filter_quality, judge_quality, learn_rules, text_statistics

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    ws = WORD.findall(text)
    windows = {}
    for i in range(len(ws) - 4):
        windows.setdefault(tuple(ws[i : i + 5]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(ws), sum(map(len, ws)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_statistics_against_brute_force(make_docs):
    rng = random.Random(4)
    parts = ["a", "b", "c", "dé", "𐍈x", "##", "|", "\n", "\n\n", " \t", "x y z u v", "<b>"]
    rows = [(i, "".join(rng.choice(parts) + rng.choice([" ", "", " "]) for _ in range(rng.randrange(0, 80)))) for i in range(300)]
    got = {r["doc_id"]: tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for r in text_statistics(make_docs(rows), ["doc_id"]).collect()}
    assert got == {d: brute(t) for d, t in rows}


def planted(make_docs, spark, n=600):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(20, 60))]
        kind = rng.choice(["good", "good", "good", "symbols", "caps"])
        if kind == "symbols":
            words = [w + rng.choice(["***", "$$"]) for w in words]
        if kind == "caps":
            words = [w.upper() + "!" for w in words]
        rows.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, int(kind == "good")))
    truth = {i: not re.search(r"[*$]|[A-Z]", t) for i, t in rows}
    return make_docs(rows), spark.createDataFrame(labels, "doc_id bigint, quality int"), truth


def test_learned_list_finds_planted_junk(make_docs, spark):
    docs, labels, truth = planted(make_docs, spark)
    rules = learn_rules(text_statistics(docs, ["doc_id"]), labels)
    assert 2 <= len(rules) <= 4 and all(1 <= len(r) <= 3 for r in rules)
    judged = judge_quality(docs, labels).collect()
    wrong = [r for r in judged if r["kept"] != (truth[r["doc_id"]] and not r["base_failed"])]
    assert len(wrong) <= 6  # most rows have no label
    kept = filter_quality(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in judged if r["kept"])


def test_list_is_one_ordered_expression(make_docs, spark):
    docs, labels, _ = planted(make_docs, spark)
    stats = text_statistics(docs, ["doc_id"])
    rules = learn_rules(stats, labels, RuleConfig(max_labelled=200))
    plan = stats.select(decision_list(rules))._jdf.queryExecution().toString()
    assert "Python" not in plan and "CASE WHEN" in plan


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, None), (None, 0)]])
def test_without_labels_of_both_kinds_the_base_decides(make_docs, spark, labels):
    docs = make_docs([(1, "ten words " * 6), (2, " ".join(f"w{i}" for i in range(12))), (3, "few")])
    got = {r["doc_id"]: r["kept"] for r in judge_quality(docs, spark.createDataFrame(labels, "doc_id bigint, quality int")).collect()}
    assert got == {1: False, 2: True, 3: False}


def test_odd_rows(odd_docs, spark):
    from odd_rows import ODD

    labels = spark.createDataFrame([(4, 1), (7, 0), (7, 1)], "doc_id bigint, quality int")
    got = judge_quality(odd_docs, labels)
    rows = sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got.collect()), key=str)
    assert rows == sorted(((d, *brute(t)) for d, t in ODD), key=str)
    assert filter_quality(odd_docs, labels).columns == odd_docs.columns


def test_empty_table(no_docs, spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert judge_quality(no_docs, labels).count() == 0 and filter_quality(no_docs, labels).count() == 0


def test_base_limits(spark):
    rows = spark.createDataFrame([(9, 0), (10, 2), (10, 3)], "n_words bigint, n_repeat_words bigint")
    assert [r[0] for r in rows.select(base_failed()).collect()] == [True, False, True]
    assert rows.select(F.lit(1)).count() == 3
