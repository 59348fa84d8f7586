"""Each stage of the pipeline beside its brute-force version or SQL, on what the stage before it kept."""

import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    import corpus_pipeline

    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        kept.append((docs, after))
        docs = after
    return kept


def sql(before, text):
    frame = before.toPandas()  # noqa: F841  seen by DuckDB
    return duckdb.sql(text.replace("{docs}", "frame")).fetchall()


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_columns(stages):
    for _, after in stages[:-1]:
        assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(r["n_chars"] == len(r["text"]) for _, after in stages[1:-1] for r in after.collect())


def test_quality_keeps_good_and_drops_bad(spark):
    """On labels enough to learn from; the smallest tables have eleven bad ones."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.01"
    before, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    after = corpus_pipeline.quality(spark, before, sf)
    left = after.join(labels, "doc_id").groupBy("quality").count().collect()
    all_ = before.join(labels, "doc_id").groupBy("quality").count().collect()
    left, all_ = ({r["quality"]: r["count"] for r in x} for x in (left, all_))
    assert left.get(1, 0) >= 0.9 * all_[1] and left.get(0, 0) <= 0.1 * all_[0]


def test_line_dedup(stages):
    from playrank.llm.queries import line_dedup_sql

    before, after = stages[1]
    text = f"""WITH {line_dedup_sql("{docs}")}
        SELECT doc_id, coalesce(string_agg(t, chr(10) ORDER BY line) FILTER (kept), '') AS text FROM line_kept GROUP BY doc_id
        HAVING regexp_matches(text, '[^\\x20\\x09-\\x0D]') OR count(*) FILTER (NOT kept) = 0"""
    assert rows(after, "doc_id", "text") == sorted(sql(before, text), key=str)


def test_near_copies(stages):
    from playrank.llm.queries import components_sql

    before, after = stages[2]
    text = f"WITH RECURSIVE {components_sql('{docs}', 5, 80)} SELECT doc_id FROM component WHERE doc_id = component_id"
    assert rows(after, "doc_id") == sorted(sql(before, text), key=str)


def test_mix(stages):
    from collections import Counter

    from test_mixing import plain_mix

    before, after = stages[3]
    times = Counter(tuple(r) for r in after.select("doc_id", "text", "source").collect())
    assert times == plain_mix([tuple(r) for r in before.select("doc_id", "text", "source").collect()])


def test_encoding(stages):
    import sentencepiece

    from playrank.llm.queries import public_model

    before, after = stages[4]
    library = sentencepiece.SentencePieceProcessor(model_file=public_model())
    expected = sorted((r["doc_id"], tuple(library.encode(r["text"]))) for r in before.collect())
    assert sorted((r["doc_id"], tuple(r["ids"])) for r in after.collect()) == expected


def test_run_equals_the_stages(spark, stages):
    import corpus_pipeline

    assert rows(corpus_pipeline.run(spark, SF), "doc_id", "ids_sha256") == rows(stages[-1][1], "doc_id", "ids_sha256")


def test_odd_rows_by_stage(odd_docs, spark):
    """What every stage makes of odd rows, row by row."""
    from collections import Counter

    import corpus_pipeline
    import sentencepiece
    from odd_rows import ODD
    from test_line_dedup import brute
    from test_mixing import plain_mix

    from playrank.llm.queries import public_model

    texts = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    good = {(r["doc_id"], r["text"]) for r in odd_docs.collect() if r["text"] and len(r["text"].split()) >= 10}
    kept = texts(corpus_pipeline.quality(spark, odd_docs, SF))
    assert set(kept) <= good and (None, ODD[0][1]) in kept
    assert texts(corpus_pipeline.lines(spark, odd_docs, SF)) == brute(ODD, 50)
    once = [r for i, r in enumerate(ODD) if r[0] != 6 and not (r[0] == 7 and ODD[i - 1][0] == 7)]
    assert texts(corpus_pipeline.near_copies(spark, odd_docs, SF)) == sorted(once, key=str)
    mixed = corpus_pipeline.mix(spark, odd_docs, SF).select("doc_id", "text", "source").collect()
    assert Counter(map(tuple, mixed)) == plain_mix([(r["doc_id"], r["text"], r["source"]) for r in odd_docs.collect()])
    library = sentencepiece.SentencePieceProcessor(model_file=public_model())
    coded = sorted(((r["doc_id"], list(r["ids"])) for r in corpus_pipeline.encode(spark, odd_docs, SF).collect()), key=str)
    assert coded == sorted(((d, library.encode(t or "")) for d, t in ODD), key=str)


def test_no_rows_by_stage(no_docs, spark):
    import corpus_pipeline

    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF).collect() == []


def test_a_stage_deletes_what_the_one_before_wrote_and_nothing_else(spark, make_docs, tmp_path):
    import os

    import corpus_pipeline

    text = lambda k: " ".join(f"w{k}n{i}" for i in range(30))
    docs = make_docs([(k, text(k // 2)) for k in range(10)])
    first = corpus_pipeline.near_copies(spark, docs, SF)
    written = list(corpus_pipeline._working[spark.sparkContext.applicationId])
    assert written and all(os.path.exists(p) for p in written)
    first.write.parquet(str(tmp_path / "kept"))
    corpus_pipeline.mix(spark, spark.read.parquet(str(tmp_path / "kept")), SF).collect()
    assert not any(os.path.exists(p) for p in written)
    # A result that was not written keeps its tables.
    unwritten = corpus_pipeline.lines(spark, make_docs([(1, "a\n" * 60 + text(1)), (2, "a\n" * 60 + text(2))]), SF)
    assert corpus_pipeline.mix(spark, unwritten, SF).count() > 0


def test_one_row_stays_of_repeated_and_null_ids(make_docs):
    """Exact rows: copies go whatever their ids are, and all else stays."""
    import corpus_pipeline

    def text(k):
        return " ".join(f"w{k}n{i}" for i in range(30))

    docs = make_docs(
        [(7, text(1)), (7, text(1)), (None, text(1)), (None, text(2)), (None, text(2)), (None, text(3)), (8, text(4)), (8, text(5)), (3, text(5) + " more"), (9, ""), (9, ""), (None, None)]
    )
    expected = [(7, text(1)), (None, text(2)), (None, text(3)), (8, text(4)), (3, text(5) + " more"), (9, ""), (9, ""), (None, None)]
    for given in (docs, docs.repartition(5)):
        assert rows(corpus_pipeline.near_copies(None, given, SF), "doc_id", "text") == sorted(expected, key=str)
