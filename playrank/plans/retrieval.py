"""Queries over sampling, candidates, retrieval models and similarity search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playrank.operators.baselines import PopularityRecommender, RandomRecommender
from playrank.operators.candidates import popularity_candidates, ranking_candidates, retrieval_candidates, split_groups
from playrank.operators.features import item_tower_features, user_tower_features
from playrank.operators.interactions import ground_truth, history, item_index
from playrank.operators.sampling import (
    pair_negatives,
    sample_eligible_users,
    sample_rows,
    sample_training_positives,
    sampled_candidates,
)
from playrank.operators.similarity import recommend_from_vectors, score_top_k, similar_items
from playrank.plans.fixtures import Prepared, item_vectors, prepared, sql, user_vectors
from playrank.plans.registry import query, rounded
from playrank.session import materialize

SEED = 42

# ---------------------------------------------------------------- oracle views used below

ITEMS = "SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS idx FROM (SELECT DISTINCT item_id FROM train) i"
TRUTH = "SELECT DISTINCT user_id, item_id FROM test WHERE is_positive"
HISTORY = "SELECT DISTINCT user_id, item_id FROM split_rows WHERE split <> 'test'"
RANKED = """SELECT item_id, row_number() OVER (ORDER BY n DESC, item_id) AS position
            FROM (SELECT item_id, count(*) AS n FROM train WHERE is_positive GROUP BY item_id) c"""
POPULAR = """SELECT user_id, rank, item_id FROM (
               SELECT u.user_id, r.item_id, row_number() OVER (PARTITION BY u.user_id ORDER BY r.position) AS rank
               FROM (SELECT DISTINCT user_id FROM truth) u CROSS JOIN ranked r
               WHERE NOT EXISTS (SELECT 1 FROM history h WHERE h.user_id = u.user_id AND h.item_id = r.item_id)) x
             WHERE rank <= {k}"""


def draw_views(users: str, seen: str, want: int, prefix: str = "") -> dict[str, str]:
    """Oracle views for ``want`` random unseen items per user: ``<prefix>picked``."""
    p = prefix
    number = "CAST(concat('0x', substr(md5(concat_ws('|', '42', user_id, j // 4)), CAST(1 + (j % 4) * 8 AS INT), 8)) AS BIGINT)"
    return {
        p + "free": f"""SELECT u.user_id, i.item_id, row_number() OVER (PARTITION BY u.user_id ORDER BY i.item_id) - 1 AS nth
                        FROM ({users}) u CROSS JOIN items i
                        WHERE NOT EXISTS (SELECT 1 FROM ({seen}) h WHERE h.user_id = u.user_id AND h.item_id = i.item_id)""",
        p + "need": f"SELECT user_id, count(*) AS m, least({want}, count(*)) AS w FROM {p}free GROUP BY user_id",
        p + "draws": f"""SELECT user_id, nth, min(j) AS j FROM (
                           SELECT user_id, j, {number} % m AS nth
                           FROM (SELECT user_id, m, unnest(range(0, CAST(4 * ceil(w * 3 / 4.0) AS BIGINT))) AS j FROM {p}need) e) d
                         GROUP BY user_id, nth""",
        p + "enough": f"""SELECT n.user_id FROM {p}need n JOIN (SELECT user_id, count(*) AS c FROM {p}draws GROUP BY user_id) d
                          ON d.user_id = n.user_id WHERE d.c >= n.w AND n.w * 2 <= n.m""",
        p + "orders": f"""SELECT user_id, nth, row_number() OVER (PARTITION BY user_id ORDER BY j) AS rank
                          FROM {p}draws WHERE user_id IN (SELECT user_id FROM {p}enough)
                          UNION ALL
                          SELECT user_id, nth, row_number() OVER (PARTITION BY user_id ORDER BY md5(concat_ws('|', '42', user_id, 'all', nth)), nth)
                          FROM (SELECT user_id, unnest(range(0, m)) AS nth FROM {p}need
                                WHERE user_id NOT IN (SELECT user_id FROM {p}enough)) s""",
        p + "picked": f"""SELECT o.user_id, CAST(o.rank AS INT) AS rank, f.item_id FROM {p}orders o
                          JOIN {p}free f ON f.user_id = o.user_id AND f.nth = o.nth
                          JOIN {p}need n ON n.user_id = o.user_id WHERE o.rank <= n.w""",
    }


def test_task(data: Prepared) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(truth, users, history) of the test split."""
    truth = ground_truth(data.test)
    return truth, truth.select("user_id").distinct(), history(data.train, data.validation)


# ---------------------------------------------------------------- sampling


@query("smp1_seeded_sample", sql("train", "SELECT user_id, item_id, hours FROM train ORDER BY md5(concat_ws('|', '42', user_id, item_id)), user_id, item_id LIMIT 3000"))
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed-size sample is the operator itself; it is drawn from the whole split."""
    return sample_rows(prepared(spark, sf_dir).train.select("user_id", "item_id", "hours"), ["user_id", "item_id"], 3000, SEED)


@query(
    "smp2_sampled_positives",
    sql(
        "train",
        """SELECT user_id, item_id, is_positive FROM train WHERE NOT is_positive UNION ALL
           (SELECT user_id, item_id, is_positive FROM train WHERE is_positive ORDER BY md5(concat_ws('|', '42', user_id, item_id)), user_id, item_id LIMIT 5000)""",
    ),
)
def sampled_positives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_training_positives(prepared(spark, sf_dir).train.select("user_id", "item_id", "is_positive"), 5000, SEED)


@query(
    "smp3_eligible_users",
    sql(
        "train test",
        """SELECT user_id FROM (SELECT DISTINCT user_id FROM test WHERE is_positive AND user_id IN (SELECT user_id FROM train)) u
           ORDER BY md5(concat_ws('|', '42', user_id)), user_id LIMIT 500""",
    ),
)
def eligible_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    return sample_eligible_users(ground_truth(data.test), data.train, 500, SEED)


_CHOSEN = """SELECT user_id, item_id, hours, event_time FROM (
               SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY md5(concat_ws('|', '42', user_id, 'pos', item_id)), item_id) AS rn
               FROM test WHERE is_positive) r WHERE rn = 1"""


@query(
    "smp4_one_positive_many_negatives",
    sql(
        "train test",
        """SELECT user_id, item_id, hours, event_time, true AS is_positive FROM chosen
           UNION ALL SELECT p.user_id, p.item_id, 0.0, c.event_time, false FROM picked p JOIN chosen c ON c.user_id = p.user_id""",
        items=ITEMS,
        chosen=_CHOSEN,
        **draw_views("SELECT user_id FROM chosen", "SELECT user_id, item_id FROM train UNION SELECT user_id, item_id FROM test WHERE is_positive", 99),
    ),
)
def one_positive_many_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    index = materialize(item_index(data.train), "items")
    return sampled_candidates(data.test, data.train, index, index.count(), 99, SEED)


@query(
    "smp5_pair_negatives",
    sql(
        "train",
        """SELECT q.user_id, q.item_id, f.item_id AS negative FROM (
             SELECT p.user_id, p.item_id, CAST(concat('0x', substr(md5(concat_ws('|', '42', p.user_id, p.item_id)), 1, 8)) AS BIGINT) % m AS nth
             FROM pos p JOIN (SELECT user_id, count(*) AS m FROM free GROUP BY user_id) c ON c.user_id = p.user_id) q
           JOIN free f ON f.user_id = q.user_id AND f.nth = q.nth""",
        items=ITEMS,
        pos="SELECT DISTINCT user_id, item_id FROM train WHERE is_positive",
        free=draw_views("SELECT DISTINCT user_id FROM pos", "SELECT * FROM pos", 1)["free"],
    ),
)
def negatives_per_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    index = materialize(item_index(data.train), "items")
    return pair_negatives(data.train.where("is_positive"), index, index.count(), SEED)


# ---------------------------------------------------------------- baselines


@query("rec1_random", sql("train test", "SELECT * FROM picked", truth=TRUTH, items=ITEMS, history=HISTORY, **draw_views("SELECT DISTINCT user_id FROM truth", "SELECT * FROM history", 20)))
def random_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    _, users, seen = test_task(data)
    return RandomRecommender(SEED).fit(data.train).recommend(users, seen, 20)


@query("rec2_popularity", sql("train test", "SELECT * FROM popular", truth=TRUTH, history=HISTORY, ranked=RANKED, popular=POPULAR.format(k=20)))
def popular(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    _, users, seen = test_task(data)
    return PopularityRecommender().fit(data.train).recommend(users, seen, 20)


# ---------------------------------------------------------------- candidates

_VAL_RECS = {
    "truth": "SELECT DISTINCT user_id, item_id FROM validation WHERE is_positive",
    "history": "SELECT DISTINCT user_id, item_id FROM train",
    "ranked": RANKED,
    "popular": POPULAR.format(k=100),
    "means": "SELECT item_id, avg(hours) AS mean_hours FROM train GROUP BY item_id",
    "times": "SELECT user_id, max(event_time) AS event_time FROM validation GROUP BY user_id",
}


def popular_candidates(data: Prepared) -> DataFrame:
    """Top 100 popular items for every validation user with a positive."""
    truth = ground_truth(data.validation)
    return PopularityRecommender().fit(data.train).recommend(truth.select("user_id"), history(data.train), 100)


@query(
    "cnd1_ranking_candidates",
    sql(
        "train validation",
        """SELECT p.user_id, p.item_id, t.event_time, round(coalesce(v.hours, m.mean_hours, 0.0), 9) AS hours, coalesce(v.is_positive, false) AS is_positive
           FROM popular p LEFT JOIN times t ON t.user_id = p.user_id LEFT JOIN means m ON m.item_id = p.item_id
           LEFT JOIN validation v ON v.user_id = p.user_id AND v.item_id = p.item_id""",
        **_VAL_RECS,
    ),
)
def candidates_with_heldout_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    return rounded(ranking_candidates(popular_candidates(data), data.validation, data.train, "heldout"), "hours", places=9)


@query(
    "cnd2_retrieval_candidates",
    sql(
        "train validation",
        """SELECT p.user_id, p.item_id, coalesce(t.event_time, (SELECT max(event_time) FROM validation)) AS event_time,
                  round(coalesce(m.mean_hours, 0.0), 9) AS hours, coalesce(v.is_positive, false) AS is_positive, 0 AS text_length,
                  false AS early_access_review, CAST(NULL AS DOUBLE) AS products_owned, CAST(0 AS DOUBLE) AS found_funny, false AS received_for_free
           FROM popular p LEFT JOIN times t ON t.user_id = p.user_id LEFT JOIN means m ON m.item_id = p.item_id
           LEFT JOIN validation v ON v.user_id = p.user_id AND v.item_id = p.item_id""",
        **_VAL_RECS,
    ),
)
def candidates_with_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    return rounded(retrieval_candidates(popular_candidates(data), data.validation, data.train), "hours", places=9)


@query(
    "cnd3_injected_positives",
    sql(
        "train validation",
        """SELECT v.user_id, v.item_id, v.hours, t.event_time, true AS is_positive FROM validation v JOIN times t ON t.user_id = v.user_id WHERE v.is_positive
           UNION ALL
           SELECT t.user_id, h.item_id, 0.0, t.event_time, false FROM times t CROSS JOIN
             (SELECT item_id FROM train GROUP BY item_id ORDER BY count(*) DESC, item_id LIMIT 100) h
           WHERE NOT EXISTS (SELECT 1 FROM validation v WHERE v.is_positive AND v.user_id = t.user_id AND v.item_id = h.item_id)""",
        times=_VAL_RECS["times"],
    ),
)
def injected_positives(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    return popularity_candidates(data.validation, data.train, data.validation.select("user_id"), 100)


@query(
    "cnd4_group_split",
    sql(
        "validation",
        """SELECT v.user_id, v.item_id, CASE WHEN r.rn <= floor(r.n * 0.8) THEN 'fit' ELSE 'valid' END AS part FROM validation v
           JOIN (SELECT user_id, row_number() OVER (ORDER BY user_id) AS rn, count(*) OVER () AS n
                 FROM (SELECT DISTINCT user_id FROM validation) u) r ON r.user_id = v.user_id""",
    ),
)
def group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_groups(prepared(spark, sf_dir).validation.select("user_id", "item_id"), 0.8)


# ---------------------------------------------------------------- tower inputs

_USER_TOWER = """
    SELECT u.user_id, round(coalesce(feat_count, 0), 9) AS feat_count, round(coalesce(feat_avg_hours, 0), 9) AS feat_avg_hours,
           round(coalesce(feat_std_hours, 0), 9) AS feat_std_hours, round(coalesce(feat_products, 0), 9) AS feat_products,
           round(coalesce(feat_text_len, 0), 9) AS feat_text_len, round(coalesce(feat_cat_div, 0), 9) AS feat_cat_div,
           round(coalesce(feat_avg_price, 0), 8) AS feat_avg_price, round(coalesce(feat_ea_rate, 0), 9) AS feat_ea_rate
    FROM (SELECT DISTINCT user_id FROM train WHERE is_positive) u LEFT JOIN (
        SELECT t.user_id, CAST(count(*) AS DOUBLE) AS feat_count, avg(hours) AS feat_avg_hours, stddev_samp(hours) AS feat_std_hours,
               avg(products_owned) AS feat_products, avg(text_length) AS feat_text_len, CAST(count(DISTINCT category) AS DOUBLE) AS feat_cat_div,
               avg(price) AS feat_avg_price, avg(CAST(early_access_item AS INT)) AS feat_ea_rate
        FROM train t LEFT JOIN catalog c ON c.item_id = t.item_id GROUP BY t.user_id) s ON s.user_id = u.user_id"""


@query("rec5_user_tower_inputs", sql("train catalog", _USER_TOWER))
def user_tower_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    rows = user_tower_features(data.train, data.catalog, data.train.where("is_positive"))
    rows = rounded(rows, *[c for c in rows.columns if c not in ("user_id", "feat_avg_price")], places=9)
    return rounded(rows, "feat_avg_price", places=8)


_TOP_VALUES = "SELECT value, row_number() OVER (ORDER BY count(*) DESC, value) AS place FROM (SELECT unnest(string_split({c}, '|')) AS value FROM catalog) v GROUP BY value"


@query(
    "rec6_item_tower_inputs",
    sql(
        "train catalog",
        """SELECT s.item_id, s.feat_popularity, round(feat_avg_hours, 9) AS feat_avg_hours, round(feat_pos_rate, 9) AS feat_pos_rate,
                  round(feat_text_len, 9) AS feat_text_len, round(ln(1 + greatest(coalesce(price, 0), 0)), 9) AS feat_log_price,
                  round(greatest(coalesce(year(release_date), 2015) - 2000, 0) / 30.0, 9) AS feat_release_year,
                  CAST(coalesce(CAST(early_access_item AS INT), 0) AS DOUBLE) AS feat_early_access,
                  round(least(coalesce(dev_count, 1), 500) / 500.0, 9) AS feat_dev_pop,
                  CAST((SELECT count(*) FROM genres g WHERE g.place <= 15 AND contains(coalesce(c.genres, ''), g.value)) AS DOUBLE) AS genre_flags,
                  CAST((SELECT sum(g.place) FROM tags g WHERE g.place <= 20 AND contains(coalesce(c.tags, ''), g.value)) AS DOUBLE) AS tag_places
           FROM (SELECT item_id, CAST(count(user_id) AS DOUBLE) AS feat_popularity, avg(hours) AS feat_avg_hours, avg(CAST(is_positive AS INT)) AS feat_pos_rate,
                        avg(text_length) AS feat_text_len FROM train GROUP BY item_id) s
           LEFT JOIN catalog c ON c.item_id = s.item_id
           LEFT JOIN (SELECT developer, count(*) AS dev_count FROM catalog GROUP BY developer) d ON d.developer = c.developer
           WHERE s.item_id IN (SELECT item_id FROM train WHERE is_positive)""",
        genres=_TOP_VALUES.format(c="genres"),
        tags=_TOP_VALUES.format(c="tags"),
    ),
)
def item_tower_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flag columns are folded into two numbers, since their names depend on the data."""
    data = prepared(spark, sf_dir)
    rows, names = item_tower_features(data.train, data.catalog, data.train.where("is_positive"))
    genres = [F.col(f"`{n}`") for n in names if n.startswith("genre_")]
    tags = [F.col(f"`{n}`") * F.lit(i + 1) for i, n in enumerate(n for n in names if n.startswith("tag_"))]
    stats = [n for n in names if n.startswith("feat_")]
    total = lambda cols: F.aggregate(F.array(*cols), F.lit(0.0), lambda a, x: a + x)
    folded = rows.select("item_id", *stats, total(genres).alias("genre_flags"), F.when(total(tags) > 0, total(tags)).alias("tag_places"))
    return rounded(folded, *[s for s in stats if s not in ("feat_popularity", "feat_early_access")], places=9)


# ---------------------------------------------------------------- scoring and similarity

_TOP = """SELECT user_id, CAST(rank AS INT) AS rank, item_id, round(score, 9) AS score FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM ({scores}) s) r WHERE rank <= {k}"""
_SCORES = """SELECT u.user_id, v.item_id, list_dot_product(u.vec, CAST(v.vec AS DOUBLE[])){bias} AS score FROM user_vectors u CROSS JOIN {items} v {where}"""
_UNSEEN = "NOT EXISTS (SELECT 1 FROM history h WHERE h.user_id = u.user_id AND h.item_id = v.item_id)"


@query("jn12_user_item_scoring", sql("user_vectors item_vectors", _TOP.format(scores=_SCORES.format(bias="", items="item_vectors", where=""), k=10)))
def user_item_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    vectors = item_vectors(spark, sf_dir)
    return rounded(score_top_k(user_vectors(data, vectors), vectors, 10), "score", places=9)


@query(
    "rec4_factor_recommendations",
    sql(
        "user_vectors train test",
        _TOP.format(
            scores=_SCORES.format(bias=" + v.bias", items="biased", where=f"WHERE u.user_id IN (SELECT user_id FROM truth) AND {_UNSEEN}"), k=20
        ),
        truth=TRUTH,
        history=HISTORY,
        biased="""SELECT v.item_id, v.vec, coalesce(ln(1 + n), 0) / 100 AS bias FROM item_vectors v
                  LEFT JOIN (SELECT item_id, count(*) AS n FROM train GROUP BY item_id) c ON c.item_id = v.item_id""",
    ),
)
def factor_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given factors and an item bias; users without factors stay empty."""
    data = prepared(spark, sf_dir)
    _, users, seen = test_task(data)
    vectors = item_vectors(spark, sf_dir)
    counts = data.train.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    biased = vectors.join(counts, "item_id", "left").select("item_id", "vec", (F.coalesce(F.log1p("n"), F.lit(0.0)) / 100).alias("bias"))
    return rounded(recommend_from_vectors(users, user_vectors(data, vectors), biased, seen, 20), "score", places=9)


@query(
    "rec8_vector_recommendations",
    sql(
        "user_vectors train test",
        _TOP.format(scores=_SCORES.format(bias="", items="item_vectors", where=f"WHERE u.user_id IN (SELECT user_id FROM truth) AND {_UNSEEN}"), k=20),
        truth=TRUTH,
        history=HISTORY,
    ),
)
def vector_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    _, users, seen = test_task(data)
    vectors = item_vectors(spark, sf_dir)
    return rounded(recommend_from_vectors(users, user_vectors(data, vectors), vectors, seen, 20), "score", places=9)


@query(
    "sim1_vector_search",
    sql(
        "user_vectors train test",
        _TOP.format(scores=_SCORES.format(bias="", items="item_vectors", where="WHERE u.user_id IN (SELECT user_id FROM truth)"), k=100),
        truth=TRUTH,
    ),
)
def vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain search: seen items stay in."""
    data = prepared(spark, sf_dir)
    _, users, _ = test_task(data)
    vectors = item_vectors(spark, sf_dir)
    return rounded(recommend_from_vectors(users, user_vectors(data, vectors), vectors, None, 100), "score", places=9)


SIMILAR = """SELECT item_id, CAST(rank AS INT) AS rank, similar_id, round(score, 9) AS score FROM (
               SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, similar_id) AS rank FROM (
                 SELECT a.item_id, b.item_id AS similar_id, list_dot_product(CAST(a.vec AS DOUBLE[]), CAST(b.vec AS DOUBLE[])) AS score
                 FROM item_vectors a JOIN item_vectors b ON a.item_id <> b.item_id) s) r WHERE rank <= 10"""


@query("sim2_similar_items", sql("item_vectors", SIMILAR))
def item_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(similar_items(item_vectors(spark, sf_dir), 10), "score", places=9)
