"""Served tables whose catalog or neighbours are too large to be broadcast: the same rows, and nobody broadcasts or repeats them."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import playrank.operators.relational as relational

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["sv1_trending", "sv4_most_played", "sv6_item_cards", "sv3_similar_items", "sv5_because_you_liked"])
def test_cards_from_a_large_catalog(spark, monkeypatch, name):
    query = entry.queries()[name]
    told = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    rows = told(query(spark, SF_DIR))
    monkeypatch.setattr(relational, "fits_broadcast", lambda *_: False)
    large = query(spark, SF_DIR)
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert told(large) == rows
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_only_heavy_keys_are_repeated(spark):
    left = spark.range(4000).select(F.col("id").alias("u"), F.when(F.col("id") % 4 == 0, 7).otherwise(F.col("id")).alias("k"))
    right = spark.range(4000).withColumnRenamed("id", "k")
    joined = relational.lookup_join(left, right, "k", "u", "left", limit=1)
    sent = joined.drop("u")._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN (k" in sent and joined.count() == 4000
    assert relational.heavy_values(left, "k") == [7]


@pytest.mark.parametrize("block", [100, 10_000])
def test_items_are_not_copied_per_shuffle_partition(spark, monkeypatch, block):
    """Items go to a few parts, however many shuffle partitions there are; lists stay the same."""
    from playrank.operators import similarity

    monkeypatch.setattr(similarity, "BLOCK_ITEMS", block)
    vec = F.array(*[F.sin(F.col("id") * (i + 1)) for i in range(4)])
    items, users = spark.range(300).select(F.col("id").alias("item_id"), vec.alias("vec")), spark.range(50).select(F.col("id").alias("user_id"), vec.alias("vec"))
    seen = spark.range(400).select((F.col("id") % 50).alias("user_id"), (F.col("id") % 350).alias("item_id"))
    rows = lambda: sorted(map(str, similarity.score_top_k(users, items, 5, seen).collect()))
    few = rows()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(similarity, "ITEM_COPIES", 1, raising=False)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "37")
        plan = similarity.score_top_k(users, items, 5, seen)._jdf.queryExecution().optimizedPlan().toString()
        assert rows() == few
        assert "sequence(0, 36" not in plan and "[0,1,2,3,4,5,6,7,8,9,10" not in plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_means_of_vectors_too_large_to_broadcast(spark, monkeypatch):
    from playrank.operators import similarity

    items = spark.range(40).select(F.col("id").alias("item_id"), F.array(*[F.sin(F.col("id") * (i + 1)).cast("float") for i in range(4)]).alias("vec"))
    pairs = spark.range(3000).select((F.col("id") % 70).alias("user_id"), (F.col("id") * 7 % 50).alias("item_id"))
    rows = lambda: {r["user_id"]: [round(x, 9) for x in r["vec"]] for r in similarity.mean_item_vectors(pairs, items, 4).collect()}
    small = rows()
    monkeypatch.setattr(relational, "fits_broadcast", lambda *_: False)
    monkeypatch.setattr(similarity, "fits_broadcast", lambda *_: False, raising=False)
    plan = similarity.mean_item_vectors(pairs, items, 4)._jdf.queryExecution().executedPlan().toString()
    assert rows() == small and len(small) == 70
    assert "REPARTITION_BY_COL" in plan and "partial_sum" in plan


def test_later_blocks_return_only_what_can_enter_a_list(spark):
    import numpy as np

    from playrank.operators.similarity import group_items, pruned_top_k

    rng = np.random.default_rng(3)
    users, items = rng.normal(size=(40, 4)), rng.normal(size=(900, 4))
    groups, none = group_items(items, np.zeros(900)), np.empty(0, np.int64)
    row, col, score, _, _ = pruned_top_k(users, groups, 20, none)
    floor = np.array([np.sort(score[row == r])[-7] for r in range(40)])
    again = pruned_top_k(users, groups, 20, none, floor)
    keep = score >= floor[row]
    assert keep.sum() == 280 and np.array_equal(again[0], row[keep]) and np.array_equal(again[1], col[keep])
    assert all(len(pruned_top_k(users, groups, 20, none, np.full(40, np.inf))[c]) == 0 for c in range(4))


def test_category_maps_are_not_sent_with_the_candidates(spark, monkeypatch):
    """Candidates meet the items first: the item lookup must not shuffle each row with its user's map of shares."""
    from playrank.operators.features import cross_and_temporal, item_features
    from playrank.plans.fixtures import prepared

    data = prepared(spark, SF_DIR)
    asked = data.validation.select("user_id", "item_id", "event_time", "hours", "is_positive")
    monkeypatch.setattr(relational, "fits_broadcast", lambda *_: False)
    rows = cross_and_temporal(asked, data.train, data.catalog, item_features(data.train, data.catalog))
    plan = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [line for line in plan if "Join LeftOuter" in line]
    assert "(user_id" in joins[0] and "_salt" not in joins[0]  # the last join is by user
    assert rows.count() == asked.count()
