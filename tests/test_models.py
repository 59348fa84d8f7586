"""Recommenders, metrics and training against brute force on small inputs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from playrank.operators import similarity
from playrank.operators.baselines import PopularityRecommender, RandomRecommender
from playrank.operators.candidates import ranking_candidates
from playrank.operators.evaluation import all_metrics, candidate_ndcg, ranker_metrics
from playrank.operators.features import NUMERIC_FEATURES, build_features, category_vocabulary, contains_value, with_category_index
from playrank.operators.interactions import ground_truth, history, item_index, item_sets
from playrank.operators.mf import BprConfig, BprRecommender, bpr_step, negatives_in_block
from playrank.operators.ranker import LambdaRanker, RankerConfig, assemble, bucketed, lambda_targets
from playrank.operators.sampling import pair_negatives, sampled_candidates
from playrank.operators.serving import active_users, serving_candidates, with_popular_fallback
from playrank.operators.towers import TowerConfig, TwoTowerRecommender, block_gradient, forward, init_tower, log_sum, loss_and_gradient, merged_log_sum
from playrank.sources.models import load_vocabulary, save_vocabulary

GAMES = [f"game{n}" for n in range(8)]


def season(seed, players=7, seen=6):
    """(seen, next, last) pairs drawn at random: everybody has seen all games but two, which come in the next two splits."""
    rng = random.Random(seed)
    parts: tuple[list, list, list] = ([], [], [])
    for p in range(players):
        order = rng.sample(GAMES, len(GAMES))
        for part, games in zip(parts, (order[:seen], order[seen : seen + 1], order[seen + 1 :]), strict=True):
            part += [(f"player{p}", g) for g in games]
    return parts


SEASON, NEXT, LAST = season(8)


def pairs(spark, rows, positive=True):
    return spark.createDataFrame([(u, i, positive) for u, i in rows], "user_id string, item_id string, is_positive boolean")


def lists(df):
    found: dict = {}
    for r in df.collect():
        found.setdefault(r["user_id"], []).append((r["rank"], r["item_id"]))
    return {u: [i for _, i in sorted(v)] for u, v in found.items()}


def crowd(spark, n_users=40, n_items=25, seed=3):
    """Users who have seen none, few, almost all and all of the items."""
    rng = random.Random(seed)
    seen = {u: set(rng.sample(range(n_items), {0: 0, 1: n_items, 2: n_items - 1, 3: n_items - 3}.get(u, rng.randrange(1, n_items)))) for u in range(n_users)}
    rows = [(u, i, rng.random() < 0.6) for u, s in seen.items() for i in s]
    df = spark.createDataFrame(rows, "user_id int, item_id int, is_positive boolean")
    users = spark.createDataFrame([(u,) for u in range(n_users)], "user_id int")
    return seen, rows, df, users


def test_history_and_truth(spark):
    liked = [(p, g) for p, g in SEASON if g != GAMES[0]]
    df = pairs(spark, SEASON).withColumn("is_positive", F.col("item_id") != GAMES[0])
    assert {r["user_id"]: r["items"] for r in item_sets(history(df)).collect()} == {p: sorted(g for q, g in SEASON if q == p) for p, _ in SEASON}
    assert {(r["user_id"], r["item_id"]) for r in ground_truth(df).collect()} == set(liked)


@pytest.mark.parametrize("k", [1, 4, 30])
def test_popularity_equals_brute_force(spark, k):
    seen, rows, train, users = crowd(spark)
    counts: dict = {}
    for _, i, positive in rows:
        counts[i] = counts.get(i, 0) + positive
    order = sorted((i for i in counts if counts[i]), key=lambda i: (-counts[i], i))
    expected = {u: [i for i in order if i not in s][:k] for u, s in seen.items()}
    got = lists(PopularityRecommender().fit(train).recommend(users, history(train), k))
    assert got == {u: v for u, v in expected.items() if v}


@pytest.mark.parametrize("k", [1, 6, 30])
def test_random_is_unseen_whole_and_repeatable(spark, k):
    seen, _, train, users = crowd(spark)
    model = RandomRecommender(seed=5).fit(train)
    got = lists(model.recommend(users, history(train), k))
    for u, s in seen.items():
        mine = got.get(u, [])
        assert len(mine) == len(set(mine)) == min(k, 25 - len(s))
        assert not set(mine) & s
    assert got == lists(model.recommend(users.repartition(9), history(train).repartition(5), k))


def test_random_is_roughly_uniform(spark):
    train = spark.range(20).select(F.lit(-1).alias("user_id"), F.col("id").cast("int").alias("item_id"), F.lit(True).alias("is_positive"))
    users = spark.range(4000).select(F.col("id").cast("int").alias("user_id"))
    recs = RandomRecommender().fit(train).recommend(users, history(train), 5)
    counts = [r["count"] for r in recs.groupBy("item_id").count().collect()]
    assert len(counts) == 20 and all(850 < c < 1150 for c in counts)


def test_negatives_avoid_own_items(spark):
    seen, _, train, _ = crowd(spark)
    index = item_index(train)
    got = pair_negatives(train, index, index.count()).collect()
    assert len(got) == sum(len(s) for s in seen.values() if len(s) < 25)
    assert all(r["negative"] not in seen[r["user_id"]] for r in got)


def test_one_positive_and_negatives(spark):
    seen, _, train, _ = crowd(spark)
    split = spark.createDataFrame([(0, 3, 2.0, True), (0, 4, 2.0, True), (3, 1, 1.5, True), (5, 2, 0.1, False)], "user_id int, item_id int, hours double, is_positive boolean")
    split = split.withColumn("event_time", F.lit("2020-01-01").cast("timestamp_ntz"))
    index = item_index(train)
    rows = sampled_candidates(split, train, index, index.count(), n_negatives=10).collect()
    mine = [r for r in rows if r["user_id"] == 0]
    assert sum(r["is_positive"] for r in mine) == 1 and len(mine) == 11
    assert not {r["item_id"] for r in mine if not r["is_positive"]} & {3, 4}
    assert {r["user_id"] for r in rows} == {0, 3}


@pytest.mark.parametrize(("block", "batch"), [(100_000, 10_000), (7, 10_000), (100_000, 9), (4, 3)])
def test_scoring_equals_brute_force(spark, monkeypatch, block, batch):
    monkeypatch.setattr(similarity, "BLOCK_ITEMS", block)
    monkeypatch.setattr(similarity, "GROUP_ITEMS", 3)
    monkeypatch.setattr(similarity, "USERS_AT_ONCE", 4)
    rng = np.random.default_rng(0)
    users, items, bias = rng.integers(-2, 3, (30, 4)).astype(float), rng.integers(-2, 3, (25, 4)).astype(float), rng.integers(-3, 4, 25).astype(float)
    seen, _, train, _ = crowd(spark, 30)
    u = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(users) if n != 5], "user_id int, vec array<double>")
    i = spark.createDataFrame([(n, v.tolist(), float(b)) for n, (v, b) in enumerate(zip(items, bias, strict=True))], "item_id int, vec array<double>, bias double")
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        for given, b in ((i, bias), (i.drop("bias"), bias * 0)):
            expected = {n: [c for c in np.lexsort((np.arange(25), -(items @ v + b))) if c not in seen[n]][:6] for n, v in enumerate(users) if n != 5}
            assert lists(similarity.score_top_k(u, given, 6, history(train))) == {n: v for n, v in expected.items() if v}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


@pytest.mark.parametrize("kind", ["lengths", "clusters", "none"])
def test_bounds_skip_groups_and_change_nothing(kind):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    if kind == "lengths":
        items = rng.normal(size=(3000, 16)) * np.exp(rng.normal(size=3000))[:, None]
    elif kind == "clusters":
        items = centres[rng.integers(0, 12, 3000)] + 0.05 * rng.normal(size=(3000, 16))
    else:
        items = rng.normal(size=(3000, 16))
    users = centres[rng.integers(0, 12, 200)] + 0.1 * rng.normal(size=(200, 16))
    bias = rng.normal(size=3000) * (kind == "lengths")
    groups = similarity.group_items(items, bias)
    assert sorted(np.concatenate(groups.members)) == list(range(3000))
    seen = np.unique(rng.integers(0, 200, 4000) * 3000 + rng.integers(0, 3000, 4000))
    row, col, score, place, skipped = similarity.pruned_top_k(users, groups, 10, seen)
    dense = users @ items.T + bias
    dense[seen // 3000, seen % 3000] = -np.inf
    expected = np.argsort(-dense, axis=1, kind="stable")[:, :10]
    assert (col.reshape(200, 10) == expected).all() and (row.reshape(200, 10) == np.arange(200)[:, None]).all()
    assert np.allclose(score, np.take_along_axis(dense, expected, 1).ravel()) and (place.reshape(200, 10) == np.arange(10)).all()
    share = skipped / (200 * len(groups.members))
    assert share > 0.5 if kind != "none" else share >= 0


def test_metrics_equal_brute_force(spark):
    rng = random.Random(2)
    recs = {u: rng.sample(range(60), 20) for u in range(30) if u % 7}
    truth = {u: set(rng.sample(range(60), rng.randrange(1, 40))) for u in range(40)}
    users = list(range(35))
    recall, ndcg = [], []
    for u in users:
        hits = [i in truth[u] for i in recs.get(u, [])]
        recall.append(sum(hits) / min(len(truth[u]), 20))
        ideal = sum(1 / math.log2(r + 2) for r in range(min(len(truth[u]), 10)))
        ndcg.append(sum(1 / math.log2(r + 2) for r, h in enumerate(hits[:10]) if h) / ideal)
    to_df = lambda rows, s: spark.createDataFrame(rows, s)
    row = all_metrics(
        to_df([(u, r + 1, i) for u, v in recs.items() for r, i in enumerate(v)], "user_id int, rank int, item_id int"),
        to_df([(u, i) for u, v in truth.items() for i in v], "user_id int, item_id int"),
        to_df([(u,) for u in users], "user_id int"),
        to_df([(i,) for i in range(50)], "item_id int"),
    ).first()
    assert row["users"] == 35
    assert row["recall"] == pytest.approx(np.mean(recall)) and row["ndcg"] == pytest.approx(np.mean(ndcg))
    assert row["coverage"] == pytest.approx(len({i for v in recs.values() for i in v} & set(range(50))) / 50)


def test_candidate_ndcg_averages_ties_and_skips(spark):
    rows = [(1, i, i == 0, 1.0) for i in range(12)]  # all tied: the positive's gain is spread evenly
    rows += [(2, i, False, float(i)) for i in range(12)]  # no positive
    rows += [(3, i, True, float(i)) for i in range(4)]  # fewer than k candidates
    rows += [(4, i, i == 11, float(i)) for i in range(12)]  # the positive is first
    df = spark.createDataFrame(rows, "user_id int, item_id int, is_positive boolean, score double")
    got = {r["user_id"]: r["ndcg"] for r in candidate_ndcg(df).collect()}
    assert got == {1: pytest.approx(sum(1 / math.log2(r + 1) for r in range(1, 11)) / 12), 4: pytest.approx(1.0)}
    row = ranker_metrics(df, spark.range(12).withColumnRenamed("id", "item_id")).first()
    assert row["users"] == 2 and row["candidate_ndcg_std"] == pytest.approx(abs(got[1] - got[4]) / 2)


def test_end_to_end_on_short_splits(spark):
    train, valid, test = (pairs(spark, r) for r in (SEASON, NEXT, LAST))
    truth = ground_truth(test)
    model = BprRecommender(BprConfig(n_factors=4, epochs=2)).fit(train)
    for recs in (model.recommend(truth, history(train, valid), 2), PopularityRecommender().fit(train).recommend(truth, history(train, valid), 2)):
        row = all_metrics(recs, truth, truth.select("user_id"), train.select("item_id").distinct(), 2, 2).first()
        assert row["users"] == len(LAST) and row["recall"] == 1.0  # one item is left for each user


def test_bpr_recommends_unseen_and_skips_unknown(spark):
    train = pairs(spark, SEASON)
    model = BprRecommender(BprConfig(n_factors=4, epochs=3)).fit(train)
    users = spark.createDataFrame([("player2",), ("stranger",)], "user_id string")
    got = lists(model.recommend(users, history(train), 5))
    assert got.keys() == {"player2"} and set(got["player2"]) == set(GAMES) - {g for p, g in SEASON if p == "player2"}
    with pytest.raises(RuntimeError):
        BprRecommender().recommend(users, history(train))
    with pytest.raises(ValueError, match="positive"):
        BprRecommender().fit(pairs(spark, SEASON, False))


def test_saved_models_recommend_the_same(spark, tmp_path):
    train, path = pairs(spark, SEASON), str(tmp_path / "models")
    users, seen = train.select("user_id").distinct(), history(train)
    fitted = BprRecommender(BprConfig(n_factors=4, epochs=2)).fit(train)
    fitted.save(path)
    assert lists(BprRecommender.load(spark, path).recommend(users, seen, 2)) == lists(fitted.recommend(users, seen, 2))
    for kind in (PopularityRecommender, RandomRecommender):
        model = kind().fit(train)
        model.save(path)
        assert lists(kind.load(spark, path).recommend(users, seen, 2)) == lists(model.recommend(users, seen, 2))
    vectors = train.select("user_id", F.array(F.lit(1.0), F.length("item_id").cast("double")).alias("vec")).dropDuplicates(["user_id"])
    towers = TwoTowerRecommender()
    towers.user_vectors = vectors
    towers.item_vectors = train.select("item_id", F.array(F.length("item_id").cast("double"), F.lit(1.0)).alias("vec")).distinct()
    towers.save(path)
    assert lists(TwoTowerRecommender.load(spark, path).recommend(users, seen, 2)) == lists(towers.recommend(users, seen, 2))
    save_vocabulary(spark.createDataFrame([(0, "a"), (1, "b"), (2, "Unknown")], "place bigint, value string"), path)
    assert {tuple(r) for r in load_vocabulary(spark, path).collect()} == {(0, "a"), (1, "b"), (2, "Unknown")}


@pytest.mark.parametrize(("block", "sums"), [(50_000, 64), (9, 2)])
def test_factors_do_not_depend_on_batches_or_tasks(spark, monkeypatch, block, sums):
    import playrank.operators.mf as module

    monkeypatch.setattr(module, "PAIRS_PER_PART", 100)
    monkeypatch.setattr(module, "BLOCK_ITEMS", block)
    monkeypatch.setattr(module, "SUMS_PER_KEY", sums)
    _, _, train, _ = crowd(spark)

    def factors():
        model = BprRecommender(BprConfig(n_factors=4, epochs=2)).fit(train)
        return {r["item_id"]: (r["vec"], r["bias"]) for r in model.item_factors.collect()}

    first = factors()
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1g")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        again = factors()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert all(np.allclose(first[i][0], again[i][0], atol=1e-6) and abs(first[i][1] - again[i][1]) < 1e-6 for i in first)


def test_negatives_are_uniform_over_what_is_unseen():
    own, u = np.array([0, 3, 4, 9] * 5000), np.repeat(np.arange(5000), 4)
    drawn = negatives_in_block(np.random.default_rng(1), u, 5000, u, own, 10)
    counts = np.bincount(drawn, minlength=10)
    assert counts[[0, 3, 4, 9]].sum() == 0 and abs(counts[[1, 2, 5, 6, 7, 8]] / len(drawn) - 1 / 6).max() < 0.02


def test_personal_lists_need_no_later_rows(spark):
    from datetime import datetime

    train = pairs(spark, SEASON).withColumns({"hours": F.lit(2.0), "event_time": F.lit("2021-05-01").cast("timestamp_ntz")})
    found = pairs(spark, NEXT)
    by_default = serving_candidates(found, train).collect()
    assert {r["event_time"] for r in by_default} == {datetime(2021, 5, 1)} and {r["hours"] for r in by_default} == {2.0}
    moment = datetime(2022, 1, 2, 3)
    assert {r["event_time"] for r in serving_candidates(found, train, moment).collect()} == {moment}


def test_bpr_step_by_hand():
    users, items, bias = np.array([[1.0, 0.0]]), np.array([[0.5, 0.5], [0.0, 1.0]]), np.array([0.2, 0.1])
    loss = bpr_step(users, items, bias, np.array([0]), np.array([0]), np.array([1]), 0.1, 0.0)
    slope = 1 / (1 + math.exp(0.6))
    assert loss == pytest.approx(math.log(1 + math.exp(-0.6)))
    assert np.allclose(users, [[1 + 0.1 * slope * 0.5, -0.1 * slope * 0.5]])
    assert np.allclose(items, [[0.5 + 0.1 * slope, 0.5], [-0.1 * slope, 1.0]])
    assert np.allclose(bias, [0.2 + 0.1 * slope, 0.1 - 0.1 * slope])


def test_draw_negatives_leaves_full_users_out():
    u, own = np.array([0, 0, 0, 1]), np.array([0, 1, 2, 1])
    drawn = negatives_in_block(np.random.default_rng(0), u, 3, u, own, 3)
    assert list(drawn[:3]) == [-1, -1, -1] and drawn[3] in (0, 2)
    # A user without items in the block may get any of its places.
    assert set(negatives_in_block(np.random.default_rng(0), np.full(200, 2), 3, u, own, 3)) == {0, 1, 2}


def test_every_stratum_trains_its_pairs_against_all_items(spark, planted, monkeypatch):
    """Over the turns of an epoch each pair is a positive once, and negatives come from every block."""
    import playrank.operators.mf as module

    monkeypatch.setattr(module, "BLOCK_ITEMS", 9)
    monkeypatch.setattr(module, "PAIRS_PER_PART", 400)
    train, _, _ = planted
    model = BprRecommender(BprConfig(n_factors=4, epochs=1, init_scale=0.1, learning_rate=1e-9, reg=0.0)).fit(train)
    # So small a step moves an item's bias by half a step per positive or negative it was in.
    moved = {r["item_id"]: r["bias"] / 0.5e-9 for r in model.item_factors.collect()}
    assert len(moved) == 40 and all(v != 0 for v in moved.values())
    positives = train.groupBy("item_id").count().collect()
    parts = -(-sum(r["count"] for r in positives) // 400)
    assert abs(sum(moved.values())) < 0.2 * sum(r["count"] for r in positives) / parts


@pytest.fixture(scope="module")
def planted(spark):
    """Users of two tastes; each plays most of the items of one half."""
    rng = random.Random(0)
    rows = [(u, i) for u in range(120) for i in range(40) if i % 2 == u % 2 and rng.random() < 0.7]
    held = [(u, i) for u in range(120) for i in range(40) if i % 2 == u % 2 and (u, i) not in set(rows)]
    frame = lambda r: spark.createDataFrame(r, "user_id int, item_id int").withColumns(
        {"is_positive": F.lit(True), "hours": F.lit(2.0) + F.col("item_id") % 2, "text_length": F.lit(3), "products_owned": F.lit(1.0)}
    )
    catalog = spark.range(40).select(
        F.col("id").cast("int").alias("item_id"), F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("category"),
        F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("genres"), F.lit("t").alias("tags"),
        F.lit(5.0).alias("price"), F.lit("2015-01-01").cast("date").alias("release_date"), F.lit(False).alias("early_access_item"), F.lit("d").alias("developer"),
    )
    return frame(rows), frame(held), catalog


@pytest.mark.parametrize("name", ["bpr", "towers", "bpr in blocks", "towers in blocks"])
def test_trained_models_beat_random_on_planted_taste(spark, planted, monkeypatch, name):
    import playrank.operators.mf as mf
    import playrank.operators.towers as towers

    if name.endswith("in blocks"):
        monkeypatch.setattr(mf, "BLOCK_ITEMS", 15)
        monkeypatch.setattr(towers, "BLOCK_ITEMS", 15)
    train, held, catalog = planted
    truth = ground_truth(held)
    random_recs = RandomRecommender().fit(train).recommend(truth, history(train), 10)
    if name.startswith("bpr"):
        model = BprRecommender(BprConfig(n_factors=8, epochs=6, init_scale=0.1, batch_size=64)).fit(train)
    else:
        model = TwoTowerRecommender(TowerConfig(out_dim=8, hidden_dim=16, epochs=8, batch_size=600, learning_rate=0.03)).fit(train, catalog)
        assert model.losses[-1] < model.losses[0]
    score = lambda recs: all_metrics(recs, truth, truth.select("user_id").distinct(), train.select("item_id").distinct(), 10, 10).first()["recall"]
    assert score(model.recommend(truth, history(train), 10)) > 1.3 * score(random_recs)


def test_tower_gradient_by_finite_difference():
    rng = np.random.default_rng(1)
    user_net, item_net = init_tower(rng, [3, 6, 4, 5]), init_tower(rng, [4, 6, 4, 5])
    x, items, target = rng.normal(size=(7, 3)), rng.normal(size=(9, 4)), rng.integers(0, 9, 7)
    _, grads = loss_and_gradient(user_net, item_net, x, items, target, 0.5, 0.1)
    net = user_net + item_net
    for n, w in enumerate(net):
        at = tuple(int(rng.integers(0, s)) for s in w.shape)
        values = []
        for step in (1e-5, -1e-5):
            w[at] += step
            values.append(loss_and_gradient(net[:6], net[6:], x, items, target, 0.5, 0.1)[0])
            w[at] -= step
        assert grads[n][at] == pytest.approx((values[0] - values[1]) / 2e-5, abs=1e-6)


@pytest.mark.parametrize("size", [1, 2, 4, 7, 23, 40])
def test_blocks_add_up_to_the_dense_softmax(size):
    rng = np.random.default_rng(size)
    user_net, item_net = init_tower(rng, [3, 6, 4, 5]), init_tower(rng, [4, 6, 4, 5])
    x, items, target = rng.normal(size=(11, 3)), rng.normal(size=(23, 4)), rng.integers(0, 23, 11)
    keep = rng.random((11, 6)) * 2, rng.random((23, 6)) * 2
    loss, grads = loss_and_gradient(user_net, item_net, x, items, target, 0.07, 0.1, keep)
    blocks = [np.arange(a, min(a + size, 23)) for a in range(0, 23, size)]
    u = forward(user_net, x, keep[0])[0]
    logs = merged_log_sum(np.stack([log_sum(u, forward(item_net, items[b], keep[1][b])[0], 0.07) for b in blocks]))
    parts = []
    for b in blocks:
        inside = np.where((target >= b[0]) & (target <= b[-1]), target - b[0], -1)
        parts.append(block_gradient(user_net, item_net, x, items[b], inside, logs, 0.07, 0.1, (keep[0], keep[1][b])))
    assert sum(p[0] for p in parts) / 11 == pytest.approx(loss, rel=1e-12)
    for n, grad in enumerate(grads):
        assert np.allclose(sum(p[1][n] for p in parts) / 11, grad, atol=1e-13)


def test_towers_do_not_depend_on_blocks(spark, planted, monkeypatch):
    import playrank.operators.towers as module

    train, _, catalog = planted
    cfg = TowerConfig(out_dim=4, hidden_dim=8, epochs=2, batch_size=500, dropout=0.0)

    def vectors(block, pairs):
        monkeypatch.setattr(module, "BLOCK_ITEMS", block)
        monkeypatch.setattr(module, "PAIRS_PER_PART", pairs)
        model = TwoTowerRecommender(cfg).fit(train, catalog)
        return model.losses, {r["item_id"]: r["vec"] for r in model.item_vectors.collect()}

    losses, whole = vectors(8192, 700)
    again, blocked = vectors(11, 700)
    assert np.allclose(losses, again, atol=1e-4) and whole.keys() == blocked.keys()
    assert all(np.allclose(whole[i], blocked[i], atol=1e-3) for i in whole)


def brute_lambdas(rows, k, truncation):
    rows = sorted(rows, key=lambda r: (-r[2], r[0]))
    ideal = sum(1 / math.log2(n + 2) for n in range(min(k, sum(r[1] for r in rows))))
    g, h = [0.0] * len(rows), [0.0] * len(rows)
    for a in range(min(truncation, len(rows))):
        for b in range(a + 1, len(rows)):
            if rows[a][1] == rows[b][1]:
                continue
            up, down = (a, b) if rows[a][1] else (b, a)
            gain = abs(1 / math.log2(a + 2) - 1 / math.log2(b + 2)) / ideal
            slope = 1 / (1 + math.exp(rows[up][2] - rows[down][2]))
            g[up] += gain * slope
            g[down] -= gain * slope
            for n in (a, b):
                h[n] += gain * slope * (1 - slope)
    return {r[0]: (g[n] / h[n], h[n]) for n, r in enumerate(rows) if h[n] > 0}


def test_lambdas_equal_brute_force(spark):
    rng = random.Random(4)
    groups = {u: [(i, int(rng.random() < 0.3), round(rng.uniform(-2, 2), 1)) for i in range(n)] for u, n in ((1, 12), (2, 3), (3, 40), (4, 5))}
    groups[4] = [(i, 0, 0.0) for i in range(5)]
    df = spark.createDataFrame([(u, i, bool(lab), s) for u, g in groups.items() for i, lab, s in g], "user_id int, item_id int, is_positive boolean, score double")
    got: dict = {}
    for r in lambda_targets(df, 10, 6).collect():
        got.setdefault(r["user_id"], {})[r["item_id"]] = (r["target"], r["weight"])
    expected = {u: brute_lambdas(g, 10, 6) for u, g in groups.items()}
    assert set(got) == {u for u, v in expected.items() if v}
    for u, mine in got.items():
        assert set(mine) == set(expected[u])
        for i, (target, weight) in mine.items():
            assert target == pytest.approx(expected[u][i][0]) and weight == pytest.approx(expected[u][i][1])


def test_rounds_need_no_shuffle_of_the_candidates(spark):
    rows = spark.range(500).select((F.col("id") % 50).alias("user_id"), F.col("id").alias("item_id"), (F.col("id") % 7 == 0).alias("is_positive"), F.lit(0.0).alias("score"))
    plan = lambda_targets(bucketed(rows, "plan_check"), 10, 30)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_ranker_learns_and_survives_saving(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for u in range(60):
        for i in range(15):
            signal = rng.random()
            rows.append((u, i, signal > 0.8, signal + rng.uniform(-0.1, 0.1), rng.random(), None if i % 3 else 1.0))
    df = spark.createDataFrame(rows, "user_id int, item_id int, is_positive boolean, good double, noise double, gap double")
    names = ["good", "noise", "gap"]
    ranker = LambdaRanker(RankerConfig(rounds=4, max_depth=3, min_rows=5, feature_fraction=1.0, rewrite_every=2))
    ranker.fit(df.where("user_id < 45"), df.where("user_id >= 45"), names)
    before = candidate_ndcg(df.withColumn("score", F.lit(0.0))).agg(F.avg("ndcg")).first()[0]
    after = candidate_ndcg(ranker.score(df)).agg(F.avg("ndcg")).first()[0]
    assert after > before + 0.2
    assert ranker.feature_importance(spark).first()["feature"] == "good"
    ranker.save(spark, str(tmp_path))
    again = LambdaRanker.load(spark, str(tmp_path), ranker.config)
    assert again.names == names
    assert {(r[0], r[1]): r[3] for r in again.score(df).collect()} == {(r[0], r[1]): r[3] for r in ranker.score(df).collect()}


def test_scores_of_flat_trees_equal_tree_by_tree_ones(spark):
    """With categories: what boosting added round by round in the JVM is what one pass over the node arrays gives."""
    import playrank.operators.ranker as module

    rng = random.Random(6)
    rows = [(u, i, rng.random() < 0.3 + 0.4 * (i % 4 == 1), rng.random(), None if rng.random() < 0.3 else rng.random(), i % 4 if i % 5 else 4) for u in range(50) for i in range(14)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, is_positive boolean, a double, b double, category_index bigint")
    vocabulary = spark.createDataFrame([(k, f"v{k}") for k in range(4)], "place bigint, value string")
    config = RankerConfig(rounds=5, max_depth=4, min_rows=3, feature_fraction=0.8, rewrite_every=2, early_stopping=9)
    by_tree, added = assemble(df, ["a", "b"], 4).withColumn("score", F.lit(0.0)), module._add
    kept = []
    module._add = lambda df, tree, columns, rate: kept.append((tree, columns, rate)) or added(df, tree, columns, rate)
    try:
        ranker = LambdaRanker(config).fit(df.where("user_id < 40"), df.where("user_id >= 40"), ["a", "b"], vocabulary)
    finally:
        module._add = added
    for tree, columns, rate in kept[: 2 * len(ranker.trees) : 2]:
        by_tree = added(by_tree, tree, columns, rate)
    expected = {(r["user_id"], r["item_id"]): r["score"] for r in by_tree.collect()}
    assert {(r["user_id"], r["item_id"]): r["score"] for r in ranker.score(df).collect()} == expected
    assert len(set(expected.values())) > 10
    importance = {r["feature"]: r["gain"] for r in ranker.feature_importance(spark).collect()}
    assert set(importance) == {"a", "b", "a_missing", "b_missing", "category_v0", "category_v1", "category_v2", "category_v3"}
    assert sum(importance.values()) == pytest.approx(sum(sum(g.values()) for g in ranker.importance)) and importance["category_v1"] > 0


def test_many_categories_are_one_sparse_vector(spark):
    """Twenty thousand values: no column per value, and the encoded rows stay short."""
    rows = spark.range(20_000).select((F.col("id") % 100).alias("user_id"), F.col("id").alias("item_id"), F.concat(F.lit("c"), "id").alias("category"), F.lit(True).alias("is_positive"), F.lit(1.5).alias("x"))
    vocabulary = category_vocabulary(rows.where("item_id < 19000"))
    indexed = with_category_index(rows, vocabulary)
    assert len(indexed.columns) == len(rows.columns) + 1
    assert assemble(indexed, ["x"], vocabulary.count())._jdf.queryExecution().toString().count("c123") == 0
    got = assemble(indexed, ["x"], vocabulary.count()).where("item_id % 1000 = 999").collect()
    places = {r["value"]: r["place"] for r in vocabulary.collect()}
    assert [v for v, _ in sorted(places.items(), key=lambda x: x[1])] == sorted(places) and len(places) == 19_000
    assert len(got) == 20
    for r in got:
        place = places.get(f"c{r['item_id']}")
        assert r["features"].size == 2 + 19_000 and dict(zip(r["features"].indices.tolist(), r["features"].values.tolist(), strict=True)) == {0: 1.5} | ({2 + place: 1.0} if place is not None else {})


def test_features_for_cold_users_and_unknown_items(spark, planted):
    train, held, catalog = planted
    at = lambda df: df.withColumn("event_time", F.lit("2020-05-01 06:00:00").cast("timestamp_ntz"))
    rows = spark.createDataFrame([(0, 1, 1.0, True), (999, 1, 2.0, False), (0, 777, None, False)], "user_id int, item_id int, hours double, is_positive boolean")
    seen = at(train).withColumn("event_time", F.lit("2020-04-01").cast("timestamp_ntz"))
    given = spark.createDataFrame([(0, "odd")], "place bigint, value string")
    features, names, vocabulary = build_features(at(rows), seen, catalog, vocabulary=given)
    assert names == NUMERIC_FEATURES and vocabulary is given
    got = {(r["user_id"], r["item_id"]): r for r in features.collect()}
    assert got[0, 1]["days_since_last"] == 30.25 and got[0, 1]["category_index"] == 0
    assert got[0, 1]["hour_sin"] == pytest.approx(1.0)
    cold = got[999, 1]
    assert (cold["user_activity_count"], cold["days_since_last"], cold["user_item_hours_vs_avg"], cold["user_category_affinity"]) == (None, 365.0, 1.0, 0.0)
    unknown = got[0, 777]
    assert (unknown["item_popularity"], unknown["category_index"], unknown["user_item_hours_vs_avg"]) == (None, 1, 1.0)
    empty, _, _ = build_features(at(rows).limit(0), seen, catalog)
    assert empty.count() == 0


def test_candidate_hours_do_not_leak_by_default(spark):
    recs = spark.createDataFrame([(1, 1, 10), (1, 2, 11)], "user_id int, rank int, item_id int")
    split = spark.createDataFrame([(1, 10, 9.0, True)], "user_id int, item_id int, hours double, is_positive boolean").withColumn("event_time", F.lit("2020-01-01").cast("timestamp_ntz"))
    train = spark.createDataFrame([(2, 10, 3.0)], "user_id int, item_id int, hours double")
    hours = lambda source: {r["item_id"]: r["hours"] for r in ranking_candidates(recs, split, train, source).collect()}
    assert hours("train_mean") == {10: 3.0, 11: 0.0}
    assert hours("heldout") == {10: 9.0, 11: 0.0}
    with pytest.raises(ValueError):
        hours("guess")


def test_flags_by_substring_or_token(spark):
    row = spark.createDataFrame([("Action RPG|Indie",)], "g string").select(
        contains_value(F.col("g"), "Action").alias("a"), contains_value(F.col("g"), "Action", "token").alias("b"), contains_value(F.col("g"), "Indie", "token").alias("c")
    ).first()
    assert tuple(row) == (1.0, 0.0, 1.0)


def test_fallback_and_active_users(spark):
    train = spark.createDataFrame([(1, 10), (2, 10), (2, 11)], "user_id int, item_id int")
    own = spark.createDataFrame([(1, 1, 11)], "user_id int, rank int, item_id int")
    users = spark.createDataFrame([(1,), (9,)], "user_id int")
    got = with_popular_fallback(own, users, own.select("user_id"), train, 2, "mine").collect()
    assert {(r["user_id"], r["rank"], r["item_id"], r["model"]) for r in got} == {(1, 1, 11, "mine"), (9, 1, 10, "popularity"), (9, 2, 11, "popularity")}
    nothing_left = with_popular_fallback(own.limit(0), users, users.where("user_id = 1"), train, 2, "mine").collect()
    assert {r["user_id"] for r in nothing_left} == {9}  # user 1 is known, though the list is empty
    listed = active_users(train.union(users.select("user_id", F.lit(5))), users.where("user_id = 9"), 2).collect()
    assert [(r["user_id"], r["history_count"], r["in_model"]) for r in listed] == [(9, 1, True), (1, 2, False)]
    with pytest.raises(ValueError):
        active_users(train, users, 501)
