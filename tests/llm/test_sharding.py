import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from playrank.llm.sharding import shard_records


def rows_of(n, hot=0.0, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, "the one hot text" if rng.random() < hot else "x" * int(rng.exponential(200))) for i in range(n)]


def check(rows, got, shards, group=0):
    assert sorted((r["doc_id"], r["text"]) for r in got) == sorted(rows)
    size = np.zeros(shards)
    slots = {}
    largest = 0
    for r in got:
        assert r["_size"] == len((r["text"] or "").encode()) + 1
        size[r["_shard"]] += r["_size"]
        largest = max(largest, r["_size"])
        slots.setdefault(r["_shard"], []).append(r["_slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert size.max() - size.min() <= 2 * max(largest, group)
    return slots


@pytest.mark.parametrize("hot", [0.0, 0.5])
@pytest.mark.parametrize("piece_bytes", [32 << 20, 500])
def test_equal_bytes_and_gapless_slots(make_docs, hot, piece_bytes):
    rows = rows_of(1500, hot)
    got = shard_records(make_docs(rows), 8, ranges=16, piece_bytes=piece_bytes)
    assert len(check(rows, got.collect(), 8)) == 8


def test_equal_texts_stand_together(make_docs):
    rows = [(i, f"text {i % 40}") for i in range(400)]
    got = shard_records(make_docs(rows), 4, ranges=8).collect()
    order = [r["text"] for r in sorted(got, key=lambda r: (r["_shard"], r["_slot"]))]
    assert sum(a != b for a, b in zip(order, order[1:], strict=False)) == 39


@pytest.mark.parametrize("piece_bytes", [32 << 20, 300])
def test_small_groups_of_equal_texts_are_not_cut(make_docs, piece_bytes):
    """Groups of one to five; beside them one text with a third of all rows, which has to be cut."""
    rows = [(i, f"text {i // 3 if i % 2 else i // 5} " + "y" * (i // 3 % 7)) for i in range(2000)] + [(i, "hot") for i in range(2000, 5000)]
    got = shard_records(make_docs(rows), 4, ranges=16, piece_bytes=piece_bytes).collect()
    check(rows, got, 4, group=200)
    shards, sizes = {}, {}
    for r in got:
        shards.setdefault(r["text"], set()).add(r["_shard"])
        sizes[r["text"]] = sizes.get(r["text"], 0) + r["_size"]
    small = [t for t in sizes if sizes[t] * 4 * 32 <= sum(sizes.values())]
    assert len(small) > 500 and all(len(shards[t]) == 1 for t in small)
    assert len(shards["hot"]) > 1 or sizes["hot"] * 4 < sum(sizes.values())


def test_shards_are_folders(spark, make_docs, tmp_path):
    rows = rows_of(200)
    shard_records(make_docs(rows), 4, path=str(tmp_path / "out")).count()
    one = spark.read.parquet(str(tmp_path / "out" / "_shard=2"))
    assert 0 < one.count() < 200


def test_reruns_agree(make_docs):
    docs = make_docs(rows_of(300, 0.3))
    key = lambda df: sorted((r["doc_id"], r["_shard"], r["_slot"]) for r in shard_records(df).collect())
    assert key(docs) == key(docs.repartition(5))


def test_odd_rows(odd_docs):
    from odd_rows import ODD

    got = shard_records(odd_docs, 3).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(ODD, key=str)
    slots = {}
    for r in got:
        slots.setdefault(r["_shard"], []).append(r["_slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_empty_table(no_docs):
    assert shard_records(no_docs).count() == 0


def test_query_columns(spark):
    from playrank.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op2_sharding"](spark, sf)
    assert dict(got.dtypes)["text_crc32"] == "bigint" and dict(got.dtypes)["grown_shard"] == "int"
    rows = got.collect()
    assert len(rows) == len(docs)
    for r in rows:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
    sizes = [r["s"] for r in got.groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 2 * max(r["size"] for r in rows)
