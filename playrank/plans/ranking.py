"""Queries over ranking features."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playrank.functions.scalars import cyclic_hour
from playrank.operators.candidates import ranking_candidates
from playrank.operators.exploration import correlated_pairs
from playrank.operators.features import (
    NUMERIC_FEATURES,
    build_features,
    category_affinity,
    category_vocabulary,
    days_since,
    item_categories,
    item_features,
    last_events,
    one_hot_vector,
    playtime_ratio,
    user_features,
    with_category_index,
)
from playrank.operators.relational import lookup_join
from playrank.plans.fixtures import Prepared, clock_events, prepared, sql
from playrank.plans.registry import query, rounded
from playrank.plans.retrieval import _VAL_RECS, popular_candidates

USER_FEATURES = """SELECT user_id, count(item_id) AS user_activity_count, avg(hours) AS user_avg_hours, count(DISTINCT item_id) AS user_distinct_items,
                          avg(CAST(is_positive AS INT)) AS user_positive_rate, sum(hours) AS user_total_hours, avg(text_length) AS user_avg_text_length
                   FROM train GROUP BY user_id"""
ITEM_FEATURES = """SELECT s.*, coalesce(c.category, 'Unknown') AS category, CAST(coalesce(c.early_access_item, false) AS INT) AS item_is_early_access
                   FROM (SELECT item_id, count(user_id) AS item_popularity, avg(hours) AS item_avg_hours, avg(CAST(is_positive AS INT)) AS item_positive_rate,
                                avg(text_length) AS item_avg_text_length FROM train GROUP BY item_id) s LEFT JOIN catalog c ON c.item_id = s.item_id"""
AFFINITY = """SELECT user_id, category, count(*) / CAST(sum(count(*)) OVER (PARTITION BY user_id) AS DOUBLE) AS user_category_affinity
              FROM (SELECT t.user_id, coalesce(c.category, 'Unknown') AS category FROM train t LEFT JOIN catalog c ON c.item_id = t.item_id) x
              GROUP BY user_id, category"""
CANDIDATES = """SELECT p.user_id, p.item_id, t.event_time, coalesce(m.mean_hours, 0.0) AS hours, coalesce(v.is_positive, false) AS is_positive
                FROM popular p LEFT JOIN times t ON t.user_id = p.user_id LEFT JOIN means m ON m.item_id = p.item_id
                LEFT JOIN validation v ON v.user_id = p.user_id AND v.item_id = p.item_id"""
FEATURES = """SELECT c.user_id, c.item_id, c.event_time, c.hours, c.is_positive, u.* EXCLUDE (user_id), i.* EXCLUDE (item_id),
                     coalesce(a.user_category_affinity, 0.0) AS user_category_affinity,
                     CASE WHEN u.user_avg_hours > 0 THEN coalesce(c.hours, u.user_avg_hours) / u.user_avg_hours ELSE 1.0 END AS user_item_hours_vs_avg,
                     least(greatest(coalesce(date_diff('microsecond', l.last, c.event_time) / 86400000000.0, 365), 0), 365) AS days_since_last,
                     sin(2 * pi() * hour(c.event_time) / 24) AS hour_sin, cos(2 * pi() * hour(c.event_time) / 24) AS hour_cos
              FROM cand c LEFT JOIN ufeat u ON u.user_id = c.user_id LEFT JOIN ifeat i ON i.item_id = c.item_id
              LEFT JOIN affinity a ON a.user_id = c.user_id AND a.category = i.category
              LEFT JOIN (SELECT user_id, max(event_time) AS last FROM train GROUP BY user_id) l ON l.user_id = c.user_id"""
FEATURE_VIEWS = {**_VAL_RECS, "cand": CANDIDATES, "ufeat": USER_FEATURES, "ifeat": ITEM_FEATURES, "affinity": AFFINITY, "feat": FEATURES}


def _round_sql(names: list[str]) -> str:
    return ", ".join(f"round(CAST({n} AS DOUBLE), 9) AS {n}" for n in names)


def validation_features(data: Prepared) -> tuple[DataFrame, list[str], DataFrame]:
    rows = ranking_candidates(popular_candidates(data), data.validation, data.train)
    return build_features(rows, data.train, data.catalog)


_USER_NAMES = NUMERIC_FEATURES[:6]
_ITEM_NAMES = NUMERIC_FEATURES[6:11]
_OWN_ROUNDING = ("user_total_hours", "user_item_hours_vs_avg")


@query("ft1_user_features", sql("train", f"SELECT user_id, {_round_sql(_USER_NAMES)} FROM ufeat".replace("user_total_hours AS DOUBLE), 9", "user_total_hours AS DOUBLE), 6"), ufeat=USER_FEATURES))
def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rounded(user_features(prepared(spark, sf_dir).train), *[n for n in _USER_NAMES if n != "user_total_hours"], places=9)
    return rounded(rows, "user_total_hours")


@query("ft2_item_features", sql("train catalog", f"SELECT item_id, category, {_round_sql(_ITEM_NAMES)} FROM ifeat", ifeat=ITEM_FEATURES))
def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    return rounded(item_features(data.train, data.catalog), *_ITEM_NAMES, places=9)


@query("ft3_category_affinity", sql("train catalog", "SELECT user_id, category, round(user_category_affinity, 9) AS user_category_affinity FROM affinity", affinity=AFFINITY))
def affinity(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    return rounded(category_affinity(data.train, data.catalog), "user_category_affinity", places=9)


@query(
    "ft4_playtime_ratio",
    sql(
        "train test",
        """SELECT t.user_id, t.item_id, round(CASE WHEN u.user_avg_hours > 0 THEN coalesce(CASE WHEN t.item_id % 4 <> 0 THEN t.hours END, u.user_avg_hours) / u.user_avg_hours
                  ELSE 1.0 END, 9) AS ratio FROM test t LEFT JOIN ufeat u ON u.user_id = t.user_id""",
        ufeat=USER_FEATURES,
    ),
)
def ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth item's hours are hidden to show the fallback to the user's mean."""
    data = prepared(spark, sf_dir)
    means = data.train.groupBy("user_id").agg(F.avg("hours").alias("mean"))
    rows = data.test.select("user_id", "item_id", F.when(F.col("item_id") % 4 != 0, F.col("hours")).alias("hours")).join(means, "user_id", "left")
    return rounded(rows.select("user_id", "item_id", playtime_ratio(F.col("hours"), F.col("mean")).alias("ratio")), "ratio", places=9)


@query(
    "ft5_days_since_last",
    sql(
        "train test",
        """SELECT t.user_id, t.item_id, round(least(greatest(coalesce(date_diff('microsecond', l.last, t.event_time) / 86400000000.0, 365), 0), 365), 6) AS days
           FROM test t LEFT JOIN (SELECT user_id, max(event_time) AS last FROM train GROUP BY user_id) l ON l.user_id = t.user_id""",
    ),
)
def recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    rows = data.test.select("user_id", "item_id", "event_time").join(last_events(data.train), "user_id", "left")
    return rounded(rows.select("user_id", "item_id", days_since(F.col("event_time"), F.col("last_event_time")).alias("days")), "days")


@query(
    "ft6_cyclic_hour",
    sql(
        "event_interactions",
        """SELECT user_id, item_id, event_time, round(sin(2 * pi() * hour(event_time) / 24), 6) AS hour_sin, round(cos(2 * pi() * hour(event_time) / 24), 6) AS hour_cos FROM event_interactions""",
    ),
)
def clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour_sin, hour_cos = cyclic_hour(F.col("event_time"))
    rows = clock_events(spark, sf_dir).select("user_id", "item_id", "event_time", hour_sin.alias("hour_sin"), hour_cos.alias("hour_cos"))
    return rounded(rows, "hour_sin", "hour_cos")


@query(
    "ft7_one_hot_category",
    sql(
        "test catalog",
        """SELECT t.user_id, t.item_id, CAST(coalesce(c.category, 'Unknown') = 'ECONOMY' AS INT) AS economy,
                  CAST(coalesce(c.category, 'Unknown') = 'Unknown' AS INT) AS unknown, 1 AS flags
           FROM test t LEFT JOIN catalog c ON c.item_id = t.item_id
           UNION ALL SELECT user_id, -item_id, 0, 0, 0 FROM test""",
    ),
)
def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary of the whole catalog; every row once more with a category outside it, which is all zero."""
    data = prepared(spark, sf_dir)
    vocabulary = category_vocabulary(data.catalog)
    rows = lookup_join(data.test.select("user_id", "item_id"), item_categories(data.catalog), "item_id", "user_id")
    unseen = rows.select("user_id", (-F.col("item_id")).alias("item_id"), F.lit("never seen before").alias("category"))
    indexed = with_category_index(rows.select("user_id", "item_id", "category").unionByName(unseen), vocabulary)
    encoded = one_hot_vector(indexed, vocabulary.count())
    named = lookup_join(encoded, vocabulary.select(F.col("place").alias("category_index"), "value"), "category_index", "user_id")
    is_value = lambda v: F.coalesce((F.col("value") == v).cast("int"), F.lit(0))
    flags = F.aggregate(vector_to_array("category_vector"), F.lit(0.0), lambda a, x: a + x).cast("int")
    return named.select("user_id", "item_id", is_value("ECONOMY").alias("economy"), is_value("Unknown").alias("unknown"), flags.alias("flags"))


@query(
    "ft8_feature_build",
    sql("train validation catalog", f"SELECT user_id, item_id, event_time, is_positive, {_round_sql([n for n in NUMERIC_FEATURES if n not in _OWN_ROUNDING])}, round(user_total_hours, 6) AS user_total_hours, round(user_item_hours_vs_avg + 1e-12, 9) AS user_item_hours_vs_avg, category FROM feat", **FEATURE_VIEWS),
)
def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The category's index is taken back to the category it stands for.

    A ratio of two means can end exactly in a 5 at any place; the nudge decides those alike.
    """
    rows, _, vocabulary = validation_features(prepared(spark, sf_dir))
    rows = lookup_join(rows, vocabulary.select(F.col("place").alias("category_index"), F.col("value").alias("category")), "category_index", "user_id")
    rows = rows.select("user_id", "item_id", "event_time", "is_positive", *NUMERIC_FEATURES, "category")
    rows = rows.withColumn("user_item_hours_vs_avg", F.col("user_item_hours_vs_avg") + F.lit(1e-12))
    rows = rounded(rows, *[n for n in NUMERIC_FEATURES if n != "user_total_hours"], places=9)
    return rounded(rows, "user_total_hours")


_PAIR_NAMES = [n for n in NUMERIC_FEATURES if n not in ("hour_sin", "hour_cos")]
_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS correlation FROM feat"
    for i, a in enumerate(_PAIR_NAMES)
    for b in _PAIR_NAMES[i + 1 :]
)


@query("ex9_correlated_features", sql("train validation catalog", f"SELECT * FROM ({_PAIRS}) p WHERE abs(correlation) > 0.9", **FEATURE_VIEWS))
def correlated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _, _ = validation_features(prepared(spark, sf_dir))
    return rounded(correlated_pairs(rows, _PAIR_NAMES), "correlation")
