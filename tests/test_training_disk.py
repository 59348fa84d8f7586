"""Training that runs for many turns holds the tables of one turn, and sends items to few parts."""

import os

from pyspark.sql import functions as F

from playrank.operators import mf
from playrank.operators.mf import BprConfig, BprRecommender


def test_turns_leave_nothing_behind(spark, monkeypatch):
    monkeypatch.setattr(mf, "BLOCK_ITEMS", 9)
    monkeypatch.setattr(mf, "PAIRS_PER_PART", 30)
    monkeypatch.setattr(mf, "MOST_PARTS", 3, raising=False)
    monkeypatch.setattr(mf, "TURN_PAIRS", 50, raising=False)
    train = spark.range(600).select((F.col("id") % 40).alias("user_id"), (F.col("id") * 7 % 30).alias("item_id"), F.lit(True).alias("is_positive"))
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    parts = []
    whole = BprRecommender._turn
    monkeypatch.setattr(BprRecommender, "_turn", lambda self, *a: (parts.append(a[5]), whole(self, *a))[1])
    model = BprRecommender(BprConfig(n_factors=4, epochs=3)).fit(train)
    left = sorted(n.split("-")[0] for n in set(os.listdir(folder)) - before)
    assert len(parts) == 3 * 4 and set(parts) == {3}  # 120 pairs: 4 blocks of 30 items, parts of 50 pairs a turn at most
    assert left.count("bpr_turn") == 1 and left.count("bpr_users") == 0 and left.count("bpr_items") == 2
    assert model.item_factors.count() == 30 and model.user_factors.count() == 40


def test_means_for_correlations_leave_no_shuffles(spark, monkeypatch):
    """The rows are made twice; the first time's shuffles are not held for the second."""
    from playrank.operators import exploration

    rows = spark.range(500).select(F.col("id").alias("a"), (F.col("id") * 3 % 17).alias("b")).repartition(4, "a")
    entered = []
    whole = exploration.own_shuffles
    monkeypatch.setattr(exploration, "own_shuffles", lambda s: (entered.append(1), whole(s))[1])
    assert exploration.correlated_pairs(rows, ["a", "b"], 0.0).count() == 1 and entered
