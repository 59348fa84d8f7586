"""Queries over evaluation, exploration tables and served tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playrank.operators.baselines import PopularityRecommender, RandomRecommender
from playrank.operators.candidates import ranking_candidates
from playrank.operators.evaluation import (
    all_metrics,
    catalog_coverage,
    compare_models,
    micro_recall,
    ndcg_at_k,
    ranker_metrics,
    recall_at_k,
)
from playrank.operators.exploration import (
    activity_quantiles,
    label_counts,
    log_hours_histogram,
    long_tail,
    split_profile,
    top_categories,
)
from playrank.operators.interactions import ground_truth, history
from playrank.operators.relational import shuffled_join
from playrank.operators.serving import active_users, because_you_liked, item_cards, similar, trending, user_history
from playrank.operators.similarity import recommend_from_vectors
from playrank.plans.fixtures import Prepared, item_vectors, prepared, sql, user_vectors
from playrank.plans.registry import query, rounded
from playrank.plans.retrieval import _SCORES, _TOP, _UNSEEN, HISTORY, ITEMS, POPULAR, RANKED, SEED, SIMILAR, TRUTH, draw_views, test_task
from playrank.session import drop_tables, materialize, recording

# ---------------------------------------------------------------- evaluation

_TEST = {"truth": TRUTH, "history": HISTORY, "ranked": RANKED, "popular": POPULAR.format(k=20)}
_USERS = """SELECT t.user_id, t.npos, coalesce(h.hits, 0) / CAST(least(t.npos, 20) AS DOUBLE) AS recall,
                   coalesce(h.dcg, 0) / list_sum(list_transform(range(1, least(t.npos, 10) + 1), lambda i: 1 / log2(i + 1))) AS ndcg
            FROM (SELECT user_id, count(*) AS npos FROM {truth} GROUP BY user_id) t
            LEFT JOIN (SELECT r.user_id, count(*) AS hits, sum(CASE WHEN r.rank <= 10 THEN 1 / log2(r.rank + 1) END) AS dcg
                       FROM {recs} r JOIN {truth} p ON p.user_id = r.user_id AND p.item_id = r.item_id GROUP BY r.user_id) h ON h.user_id = t.user_id"""
_COVERAGE = """(SELECT count(DISTINCT item_id) FROM {recs} WHERE item_id IN (SELECT item_id FROM train)) / CAST((SELECT count(DISTINCT item_id) FROM train) AS DOUBLE)"""
_ALL = "SELECT {tags}count(*) AS users, round(avg(recall), 6) AS recall, round(avg(ndcg), 6) AS ndcg, round({coverage}, 6) AS coverage FROM ({users}) u"


def popular_recs(data: Prepared, k: int = 20) -> DataFrame:
    _, users, seen = test_task(data)
    return materialize(PopularityRecommender().fit(data.train).recommend(users, seen, k), "recs")


@query(
    "ev1_history_and_truth",
    sql(
        "train validation test",
        """SELECT 'validation' AS split, (SELECT count(*) FROM (SELECT DISTINCT user_id, item_id FROM train) h) AS history_pairs,
                  (SELECT count(*) FROM validation WHERE is_positive) AS truth_pairs, (SELECT count(DISTINCT user_id) FROM validation WHERE is_positive) AS users
           UNION ALL SELECT 'test', (SELECT count(*) FROM (SELECT user_id, item_id FROM train UNION SELECT user_id, item_id FROM validation) h),
                  (SELECT count(*) FROM test WHERE is_positive), (SELECT count(DISTINCT user_id) FROM test WHERE is_positive)""",
    ),
)
def history_and_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    rows = None
    for name, seen, held in (("validation", history(data.train), data.validation), ("test", history(data.train, data.validation), data.test)):
        truth = ground_truth(held).agg(F.count(F.lit(1)).alias("truth_pairs"), F.count_distinct("user_id").alias("users"))
        counts = seen.agg(F.count(F.lit(1)).alias("history_pairs")).unionByName(truth, allowMissingColumns=True)
        one = counts.agg(F.lit(name).alias("split"), *[F.max(c).alias(c) for c in ("history_pairs", "truth_pairs", "users")])
        rows = one if rows is None else rows.unionByName(one)
    return rows


@query("ev2_recall", sql("train test", f"SELECT count(*) AS users, round(avg(recall), 6) AS recall FROM ({_USERS.format(truth='truth', recs='popular')}) u", **_TEST))
def recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    truth, users, _ = test_task(data)
    return rounded(recall_at_k(popular_recs(data), truth, users, 20), "recall")


@query("ev3_ndcg", sql("train test", f"SELECT count(*) AS users, round(avg(ndcg), 6) AS ndcg FROM ({_USERS.format(truth='truth', recs='popular')}) u", **_TEST))
def ndcg(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    truth, users, _ = test_task(data)
    return rounded(ndcg_at_k(popular_recs(data), truth, users, 10), "ndcg")


@query(
    "ev4_catalog_coverage",
    sql(
        "train test",
        f"""SELECT (SELECT count(DISTINCT item_id) FROM popular WHERE item_id IN (SELECT item_id FROM train)) AS covered,
                   (SELECT count(DISTINCT item_id) FROM train) AS catalog_items, round({_COVERAGE.format(recs='popular')}, 6) AS coverage""",
        **_TEST,
    ),
)
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    return rounded(catalog_coverage(popular_recs(data), data.train.select("item_id").distinct(), 20), "coverage")


@query("ev5_all_metrics", sql("train test", _ALL.format(tags="", coverage=_COVERAGE.format(recs="popular"), users=_USERS.format(truth="truth", recs="popular")), **_TEST))
def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    truth, users, _ = test_task(data)
    return rounded(all_metrics(popular_recs(data), truth, users, data.train.select("item_id").distinct()), "recall", "ndcg", "coverage")


_SCORED = """SELECT p.user_id, p.item_id, t.user_id IS NOT NULL AS is_positive, CAST((p.rank - 1) // 3 AS DOUBLE) * -1 AS score
             FROM popular p LEFT JOIN truth t ON t.user_id = p.user_id AND t.item_id = p.item_id"""
_RANKED_SCORES = """SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS r FROM scored"""
_TIES = """SELECT user_id, score, avg(CAST(is_positive AS INT)) * sum(CASE WHEN r <= 10 THEN 1 / log2(r + 1) ELSE 0 END) AS dcg,
                  sum(CAST(is_positive AS INT)) AS pos, count(*) AS n FROM placed GROUP BY user_id, score"""
_CAND_NDCG = """SELECT user_id, sum(dcg) / list_sum(list_transform(range(1, CAST(least(sum(pos), 10) AS BIGINT) + 1), lambda i: 1 / log2(i + 1))) AS ndcg
                FROM ties GROUP BY user_id HAVING sum(pos) > 0 AND sum(n) >= 10"""


@query(
    "ev6_ranker_metrics",
    sql(
        "train test catalog",
        """SELECT round(avg(ndcg), 6) AS candidate_ndcg, round(stddev_pop(ndcg), 6) AS candidate_ndcg_std, count(*) AS users,
                  round((SELECT count(DISTINCT item_id) FROM placed WHERE r <= 10 AND user_id IN (SELECT user_id FROM own)) /
                        CAST((SELECT count(*) FROM catalog) AS DOUBLE), 6) AS coverage FROM own""",
        **{**_TEST, "popular": POPULAR.format(k=100)},
        scored=_SCORED,
        placed=_RANKED_SCORES,
        ties=_TIES,
        own=_CAND_NDCG,
    ),
)
def ranker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Popularity rank in steps of three as the score, so that every score is tied."""
    data = prepared(spark, sf_dir)
    recs = popular_recs(data, 100)
    labelled = shuffled_join(ranking_candidates(recs, data.test, data.train), recs, ["user_id", "item_id"])
    scored = labelled.withColumn("score", -F.floor((F.col("rank") - 1) / 3).cast("double"))
    return rounded(ranker_metrics(scored, data.catalog), "candidate_ndcg", "candidate_ndcg_std", "coverage")


def _model_views(split: str, seen: str) -> dict[str, str]:
    p = split + "_"
    return {
        p + "truth": f"SELECT DISTINCT user_id, item_id FROM {split} WHERE is_positive",
        p + "history": f"SELECT DISTINCT user_id, item_id FROM split_rows WHERE {seen}",
        p + "factors": _TOP.format(
            scores=_SCORES.format(bias="", items="item_vectors", where=f"WHERE u.user_id IN (SELECT user_id FROM {p}truth) AND {_UNSEEN}").replace("FROM history h", f"FROM {p}history h"), k=20
        ),
        p + "popular": POPULAR.format(k=20).replace("FROM truth", f"FROM {p}truth").replace("FROM history", f"FROM {p}history"),
        **{n: t.replace("FROM items", "FROM items") for n, t in draw_views(f"SELECT DISTINCT user_id FROM {p}truth", f"SELECT * FROM {p}history", 20, p).items()},
    }


def _model_row(split: str, model: str, recs: str) -> str:
    tags = f"'{split}' AS split, '{model}' AS model, "
    return _ALL.format(tags=tags, coverage=_COVERAGE.format(recs=recs), users=_USERS.format(truth=f"{split}_truth", recs=recs))


@query(
    "ev7_model_comparison",
    sql(
        "train validation test user_vectors item_vectors",
        " UNION ALL ".join(
            _model_row(s, m, r) for s in ("validation", "test") for m, r in (("popularity", f"{s}_popular"), ("random", f"{s}_picked"), ("factors", f"{s}_factors"))
        ),
        items=ITEMS,
        ranked=RANKED,
        **_model_views("validation", "split = 'train'"),
        **_model_views("test", "split <> 'test'"),
    ),
)
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Popularity, random and given factors; whoever has no factors is evaluated with an empty list."""
    data = prepared(spark, sf_dir)
    vectors = item_vectors(spark, sf_dir)
    known_users = materialize(user_vectors(data, vectors), "user_vectors")
    models = {
        "popularity": PopularityRecommender().fit(data.train).recommend,
        "random": RandomRecommender(SEED).fit(data.train).recommend,
        "factors": lambda users, seen, k: recommend_from_vectors(users, known_users, vectors, seen, k),
    }
    splits = {"validation": (data.validation, history(data.train)), "test": (data.test, history(data.train, data.validation))}
    truths = {s: materialize(ground_truth(held), "truth") for s, (held, _) in splits.items()}
    runs = {}
    for split, (_, seen) in splits.items():
        known = materialize(seen, "history")
        for name, recommend in models.items():
            with recording() as made:
                recs = recommend(truths[split].select("user_id").distinct(), known, 20)
                runs[(split, name)] = materialize(recs, "recs")
            drop_tables(spark, made[:-1])  # what the lists were made from
    compared = compare_models(runs, truths, data.train.select("item_id").distinct())
    return rounded(compared, "recall", "ndcg", "coverage")


@query(
    "ev9_training_recall",
    sql(
        "user_vectors train",
        """SELECT count(h.user_id) AS hits, count(*) AS relevant, round(count(h.user_id) / CAST(count(*) AS DOUBLE), 6) AS recall
           FROM train t LEFT JOIN found h ON h.user_id = t.user_id AND h.item_id = t.item_id WHERE t.user_id IN (SELECT user_id FROM user_vectors)""",
        found=_TOP.format(scores=_SCORES.format(bias="", items="item_vectors", where=""), k=100),
    ),
)
def training_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall@100 on the training items themselves, so nothing is masked."""
    data = prepared(spark, sf_dir)
    vectors = item_vectors(spark, sf_dir)
    known = materialize(user_vectors(data, vectors), "user_vectors")
    recs = recommend_from_vectors(known, known, vectors, None, 100)
    return rounded(micro_recall(recs, history(data.train), known.select("user_id"), 100), "recall")


# ---------------------------------------------------------------- exploration


@query(
    "ex2_log_hours_histogram",
    sql(
        "interactions",
        """SELECT b AS bin, round(lo + b * (hi - lo) / 60, 6) AS left_edge, coalesce(n, 0) AS n FROM (SELECT unnest(range(60)) AS b) s
           LEFT JOIN (SELECT CAST(least(floor((x - lo) / ((hi - lo) / 60)), 59) AS BIGINT) AS k, count(*) AS n FROM logged, edges GROUP BY 1) c ON c.k = s.b, edges""",
        logged="SELECT ln(1 + least(greatest(hours, 0), (SELECT quantile_cont(hours, 0.995) FROM interactions))) AS x FROM interactions",
        edges="SELECT min(x) AS lo, max(x) AS hi FROM logged",
    ),
)
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(log_hours_histogram(prepared(spark, sf_dir).labelled), "left_edge")


@query("ex3_label_counts", sql("interactions", "SELECT is_positive, count(*) AS n FROM interactions GROUP BY is_positive"))
def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_counts(prepared(spark, sf_dir).labelled)


@query("ex4_user_long_tail", sql("interactions", "SELECT user_id, n, row_number() OVER (ORDER BY n DESC, user_id) AS rank FROM (SELECT user_id, count(*) AS n FROM interactions GROUP BY user_id) c"))
def user_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long_tail(prepared(spark, sf_dir).labelled, "user_id")


@query(
    "ex6_split_profile",
    sql(
        "split_rows",
        """SELECT split, count(*) AS rows, count(DISTINCT user_id) AS unique_users, count(DISTINCT item_id) AS unique_items,
                  round(avg(CAST(is_positive AS INT)), 6) AS positive_rate, round(quantile_cont(hours, 0.5), 6) AS median_hours, round(quantile_cont(hours, 0.9), 6) AS p90_hours,
                  CAST(min(event_time) AS DATE) AS start_day, CAST(max(event_time) AS DATE) AS end_day FROM split_rows GROUP BY split""",
    ),
)
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(split_profile(prepared(spark, sf_dir).labelled), "positive_rate", "median_hours", "p90_hours")


@query(
    "ex7_activity_quantiles",
    sql(
        "train",
        " UNION ALL ".join(
            f"""SELECT '{k}' AS kind, CAST(unnest([0.5, 0.75, 0.9, 0.95, 0.99]) AS DOUBLE) AS quantile,
                       round(unnest(quantile_cont(CAST(n AS DOUBLE), [0.5, 0.75, 0.9, 0.95, 0.99])), 6) AS value FROM (SELECT count(*) AS n FROM train GROUP BY {k}_id) c"""
            for k in ("user", "item")
        ),
    ),
)
def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = prepared(spark, sf_dir).train
    parts = [activity_quantiles(train, f"{k}_id").select(F.lit(k).alias("kind"), "quantile", "value") for k in ("user", "item")]
    return rounded(parts[0].unionByName(parts[1]), "value")


@query("ex8_top_categories", sql("catalog", "SELECT coalesce(category, 'Unknown') AS category, count(*) AS n FROM catalog GROUP BY 1 ORDER BY n DESC, category LIMIT 12"))
def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_categories(prepared(spark, sf_dir).catalog)


# ---------------------------------------------------------------- served tables

_CARD = "coalesce(c.title, concat('Game ', {id})) AS title, coalesce(c.category, 'Unknown') AS category, coalesce(c.image_url, '') AS image_url"


@query(
    "sv1_trending",
    sql(
        "train catalog",
        f"""SELECT p.item_id, p.n, CAST(row_number() OVER (ORDER BY p.n DESC, p.item_id) AS INT) AS rank, {_CARD.format(id="p.item_id")}
            FROM (SELECT item_id, count(*) AS n FROM train GROUP BY item_id ORDER BY n DESC, item_id LIMIT 20) p LEFT JOIN catalog c ON c.item_id = p.item_id""",
    ),
)
def trending_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    return trending(data.train, data.catalog)


@query("sv3_similar_items", sql("item_vectors catalog", f"SELECT s.item_id, rank, similar_id, score, {_CARD.format(id='similar_id')} FROM near s LEFT JOIN catalog c ON c.item_id = s.similar_id", near=SIMILAR))
def similar_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(similar(item_vectors(spark, sf_dir), prepared(spark, sf_dir).catalog), "score", places=9)


_PLAYED = "SELECT user_id, item_id, hours AS total_hours, CAST(row_number() OVER (PARTITION BY user_id ORDER BY hours DESC, item_id) AS INT) AS rank FROM test"


@query(
    "sv4_most_played",
    sql("test catalog", f"SELECT p.user_id, p.item_id, total_hours, rank, {_CARD.format(id='p.item_id')} FROM played p LEFT JOIN catalog c ON c.item_id = p.item_id WHERE rank <= 10", played=_PLAYED),
)
def played(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    return user_history(data.test, data.catalog)


@query(
    "sv5_because_you_liked",
    sql(
        "test catalog item_vectors",
        f"""SELECT p.user_id, p.item_id AS liked_id, s.rank, s.similar_id, s.score, {_CARD.format(id='s.similar_id')}
            FROM played p JOIN near s ON s.item_id = p.item_id LEFT JOIN catalog c ON c.item_id = s.similar_id WHERE p.rank = 1""",
        played=_PLAYED,
        near=SIMILAR,
    ),
)
def because(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    return rounded(because_you_liked(data.test, item_vectors(spark, sf_dir), data.catalog), "score", places=9)


@query(
    "sv6_item_cards",
    sql(
        "interactions catalog",
        f"SELECT o.item_id, {_CARD.format(id='o.item_id')} FROM (SELECT item_id FROM interactions UNION SELECT -item_id FROM interactions) o LEFT JOIN catalog c ON c.item_id = o.item_id",
    ),
)
def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item once more under an id that the catalog lacks, so that the defaults show."""
    data = prepared(spark, sf_dir)
    seen = data.labelled.select("item_id").distinct()
    return item_cards(seen.unionByName(seen.select((-F.col("item_id")).alias("item_id"))).distinct(), data.catalog)


@query(
    "sv7_active_users",
    sql(
        "train test",
        """SELECT user_id, history_count, user_id IN (SELECT user_id FROM train WHERE is_positive) AS in_model
           FROM (SELECT user_id, count(*) AS history_count FROM test GROUP BY user_id) t ORDER BY in_model DESC, history_count DESC, user_id LIMIT 100""",
    ),
)
def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    return active_users(data.test, data.train.where("is_positive"))
