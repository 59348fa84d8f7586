"""Offline metrics over long recommendation tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playrank.functions.scalars import discount, ideal_dcg
from playrank.operators.relational import shuffled_join


def user_metrics(recs: DataFrame, truth: DataFrame, users: DataFrame, recall_k: int = 20, ndcg_k: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Recall and NDCG of every evaluated user who has positives; an empty list scores 0.

    Recommendations, truth and users are stacked and grouped instead of joined: one shuffle
    by user serves both groupings, and no user is lost for lack of recommendations. ``by``
    names further columns that all three have, for several lists of a user side by side.
    """
    depth = max(recall_k, ndcg_k)
    item_type = truth.schema["item_id"].dataType
    listed = recs.where(F.col("rank") <= depth).select(
        *by, "user_id", "item_id", F.col("rank").cast("int").alias("rank"), F.lit(0).alias("positive"), F.lit(0).alias("evaluated")
    )
    relevant = truth.select(*by, "user_id", "item_id", F.lit(None).cast("int").alias("rank"), F.lit(1).alias("positive"), F.lit(0).alias("evaluated"))
    asked = users.select(
        *by, "user_id", F.lit(None).cast(item_type).alias("item_id"), F.lit(None).cast("int").alias("rank"), F.lit(0).alias("positive"), F.lit(1).alias("evaluated")
    )
    stacked = listed.unionByName(relevant).unionByName(asked).repartition("user_id")
    pairs = stacked.groupBy(*by, "user_id", "item_id").agg(
        F.min("rank").alias("rank"), F.max("positive").alias("positive"), F.max("evaluated").alias("evaluated")
    )
    hit = F.col("positive") == 1
    gained = F.coalesce(F.sum(F.when(hit & (F.col("rank") <= ndcg_k), discount(F.col("rank")))), F.lit(0.0))
    per_user = pairs.groupBy(*by, "user_id").agg(
        F.sum("positive").alias("positives"),
        F.max("evaluated").alias("evaluated"),
        F.count(F.when(hit & (F.col("rank") <= recall_k), 1)).alias("hits"),
        gained.alias("dcg"),
    )
    return per_user.where((F.col("evaluated") == 1) & (F.col("positives") > 0)).select(
        *by,
        "user_id",
        "positives",
        "hits",
        (F.col("hits") / F.least(F.col("positives"), F.lit(recall_k))).alias("recall"),
        (F.col("dcg") / ideal_dcg(F.col("positives"), ndcg_k)).alias("ndcg"),
    )


def recall_at_k(recs: DataFrame, truth: DataFrame, users: DataFrame, k: int = 20) -> DataFrame:
    per_user = user_metrics(recs, truth, users, recall_k=k)
    return per_user.agg(F.count(F.lit(1)).alias("users"), F.coalesce(F.avg("recall"), F.lit(0.0)).alias("recall"))


def ndcg_at_k(recs: DataFrame, truth: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    per_user = user_metrics(recs, truth, users, ndcg_k=k)
    return per_user.agg(F.count(F.lit(1)).alias("users"), F.coalesce(F.avg("ndcg"), F.lit(0.0)).alias("ndcg"))


def catalog_coverage(recs: DataFrame, catalog: DataFrame, k: int = 20) -> DataFrame:
    """Share of catalog items that appear in some user's first ``k``."""
    listed = recs.where(F.col("rank") <= k).select("item_id", F.lit(1).alias("listed"), F.lit(0).alias("known"))
    known = catalog.select("item_id", F.lit(0).alias("listed"), F.lit(1).alias("known"))
    items = listed.unionByName(known).groupBy("item_id").agg(F.max("listed").alias("listed"), F.max("known").alias("known"))
    counts = items.agg(
        F.sum(F.col("listed") * F.col("known")).alias("covered"),
        F.sum("known").alias("catalog_items"),
    )
    share = F.when(F.col("catalog_items") > 0, F.col("covered") / F.col("catalog_items")).otherwise(F.lit(0.0))
    return counts.select("covered", "catalog_items", share.alias("coverage"))


def all_metrics(recs: DataFrame, truth: DataFrame, users: DataFrame, catalog: DataFrame, recall_k: int = 20, ndcg_k: int = 10) -> DataFrame:
    """Users, recall, NDCG and coverage in one row."""
    quality = user_metrics(recs, truth, users, recall_k, ndcg_k).agg(
        F.count(F.lit(1)).alias("users"),
        F.coalesce(F.avg("recall"), F.lit(0.0)).alias("recall"),
        F.coalesce(F.avg("ndcg"), F.lit(0.0)).alias("ndcg"),
    )
    covered = catalog_coverage(recs, catalog, recall_k).select("coverage")
    rows = quality.unionByName(covered, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in ("users", "recall", "ndcg", "coverage")])


def compare_models(runs: dict[tuple[str, str], DataFrame], truths: dict[str, DataFrame], catalog: DataFrame, recall_k: int = 20, ndcg_k: int = 10) -> DataFrame:
    """One row per (split, model); every user with a positive in the split is evaluated.

    All lists are stacked under their split and model, so one grouped pass gives all metrics.
    """
    by = ["split", "model"]
    tagged = lambda rows, split, model: rows.withColumns({"split": F.lit(split), "model": F.lit(model)})
    recs = reduce(DataFrame.unionByName, [tagged(r.select("user_id", "rank", "item_id"), *key) for key, r in runs.items()])
    truth = reduce(DataFrame.unionByName, [tagged(truths[key[0]].select("user_id", "item_id"), *key) for key in runs])
    quality = user_metrics(recs, truth, truth.select(*by, "user_id").distinct(), recall_k, ndcg_k, by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("users"), F.avg("recall").alias("recall"), F.avg("ndcg").alias("ndcg")
    )
    known = catalog.select("item_id").distinct()
    listed = recs.where(F.col("rank") <= recall_k).select(*by, "item_id").distinct().join(known, "item_id", "left_semi")
    covered = listed.groupBy(*by).agg(F.count(F.lit(1)).alias("covered"))
    total = known.count()
    every = recs.sparkSession.createDataFrame(list(runs), "split string, model string")
    zero = lambda c, kind="double": F.coalesce(F.col(c), F.lit(0).cast(kind)).alias(c)
    rows = every.join(quality, by, "left").join(covered, by, "left")
    share = F.coalesce("covered", F.lit(0)) / F.lit(max(total, 1))
    return rows.select(*by, zero("users", "bigint"), zero("recall"), zero("ndcg"), share.alias("coverage"))


def ranked_candidates(scored: DataFrame, k: int) -> DataFrame:
    """Per-user rank by score (ties by item) with the discount each rank earns."""
    order = W.partitionBy("user_id").orderBy(F.col("score").desc(), F.col("item_id").asc())
    ranked = scored.withColumn("rank", F.row_number().over(order))
    return ranked.withColumn("discount", F.when(F.col("rank") <= k, discount(F.col("rank"))).otherwise(F.lit(0.0)))


def candidate_ndcg(scored: DataFrame, k: int = 10) -> DataFrame:
    """NDCG of ranked candidates per user, with the ideal taken from the candidates alone.

    Equal scores share their average gain. Users without a positive or with fewer than ``k``
    candidates are skipped.
    """
    label = F.col("is_positive").cast("double")
    ties = ranked_candidates(scored, k).groupBy("user_id", "score").agg(
        (F.avg(label) * F.sum("discount")).alias("dcg"),
        F.sum(label).alias("positives"),
        F.count(F.lit(1)).alias("n"),
    )
    per_user = ties.groupBy("user_id").agg(
        F.sum("dcg").alias("dcg"), F.sum("positives").alias("positives"), F.sum("n").alias("candidates")
    )
    return per_user.where((F.col("positives") > 0) & (F.col("candidates") >= k)).select(
        "user_id", (F.col("dcg") / ideal_dcg(F.col("positives"), k)).alias("ndcg")
    )


def ranker_metrics(scored: DataFrame, catalog: DataFrame, k: int = 10) -> DataFrame:
    """Mean and population deviation of candidate NDCG, users, and coverage of the whole catalog."""
    users = candidate_ndcg(scored, k)
    quality = users.agg(
        F.coalesce(F.avg("ndcg"), F.lit(0.0)).alias("candidate_ndcg"),
        F.coalesce(F.stddev_pop("ndcg"), F.lit(0.0)).alias("candidate_ndcg_std"),
        F.count(F.lit(1)).alias("users"),
    )
    shown = shuffled_join(ranked_candidates(scored, k).where(F.col("rank") <= k), users.select("user_id"), "user_id", "left_semi")
    covered = catalog_coverage(shown, catalog, k).select("coverage")
    rows = quality.unionByName(covered, allowMissingColumns=True)
    names = ("candidate_ndcg", "candidate_ndcg_std", "users", "coverage")
    return rows.agg(*[F.max(c).alias(c) for c in names])


def stage_comparison(stages: dict[str, tuple[DataFrame, DataFrame]], truth: DataFrame, users: DataFrame, catalog: DataFrame, recall_k: int = 20, ndcg_k: int = 10) -> DataFrame:
    """Both NDCG definitions side by side for each stage, under different names.

    A stage is (recommendations, scored candidates).
    """
    rows = []
    for stage, (recs, scored) in stages.items():
        full = user_metrics(recs, truth, users, recall_k, ndcg_k).agg(
            F.avg("recall").alias("recall"), F.avg("ndcg").alias("ndcg_full_truth")
        )
        own = ranker_metrics(scored, catalog, ndcg_k).select(
            F.col("candidate_ndcg").alias("ndcg_candidates"), F.col("coverage").alias("coverage")
        )
        both = full.unionByName(own, allowMissingColumns=True)
        names = ("recall", "ndcg_full_truth", "ndcg_candidates", "coverage")
        rows.append(both.agg(*[F.max(c).alias(c) for c in names]).select(F.lit(stage).alias("stage"), "*"))
    return reduce(DataFrame.unionByName, rows)


def micro_recall(recs: DataFrame, relevant: DataFrame, users: DataFrame, k: int = 100) -> DataFrame:
    """Hits over relevant pairs, all users together."""
    pairs = user_metrics(recs, relevant, users, recall_k=k)
    return pairs.agg(
        F.sum("hits").alias("hits"), F.sum("positives").alias("relevant"), (F.sum("hits") / F.sum("positives")).alias("recall")
    )
