"""Tables behind the data report."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playrank.functions.scalars import clip
from playrank.operators.interactions import positive_rate
from playrank.operators.relational import global_rank, running_total
from playrank.session import own_shuffles

# The quantiles and sizes the report shows.
ACTIVITY_QUANTILES = (0.50, 0.75, 0.90, 0.95, 0.99)
HOURS_QUANTILES = (0.25, 0.50, 0.75, 0.90, 0.95, 0.99)
HISTOGRAM_BINS = 60
HISTOGRAM_CLIP = 0.995
TOP_CATEGORIES = 12
CORRELATION_LIMIT = 0.9


def dataset_summary(interactions: DataFrame, catalog: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Counts, sparsity, positive rate and time range in one row."""
    facts = interactions.agg(
        F.count(F.lit(1)).alias("interactions"),
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("item_id").alias("items"),
        F.sum(F.col("is_positive").cast("int")).alias("positive_interactions"),
        positive_rate().alias("positive_rate"),
        F.min("event_time").alias("start_date"),
        F.max("event_time").alias("end_date"),
    )
    known = F.count(F.when(F.coalesce("category", F.lit("Unknown")) != "Unknown", 1))
    listed = catalog.agg(F.count(F.lit(1)).alias("catalog_items"), known.alias("items_with_known_metadata"))
    rows = facts.unionByName(listed, allowMissingColumns=True)
    merged = rows.agg(*[F.max(c).alias(c) for c in rows.columns])
    possible = F.col("users").cast("double") * F.col("items")
    return merged.select(
        "*",
        F.when(possible > 0, 1 - F.col("interactions") / possible).alias("sparsity"),
        F.lit(threshold).alias("positive_threshold_hours"),
    )


def quantiles(rows: DataFrame, column: str, probabilities: Sequence[float], by: str | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation: (by, quantile, value).

    Values are counted first, then ranked by a distributed running sum, so neither a hot
    value nor many different ones gather in one task. ``by`` names a column of few groups.
    """
    group = F.col(by) if by else F.lit(0)
    counts = rows.where(F.col(column).isNotNull()).groupBy(group.alias("_g"), F.col(column).cast("double").alias("_v")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    ranked = running_total(counts, [F.col("_g"), F.col("_v")], "_n", "_upto")
    groups = ranked.groupBy("_g").agg(F.sum("_n").alias("_size"), F.min(F.col("_upto") - F.col("_n")).alias("_start"))
    position = F.col("p") * (F.col("_size") - 1)
    targets = groups.select("*", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("p")).select(
        "_g",
        "p",
        (position - F.floor(position)).alias("_part"),
        (F.col("_start") + F.floor(position)).alias("_low"),
        (F.col("_start") + F.ceil(position)).alias("_high"),
    )
    holds = {e: (F.col(e) >= F.col("_upto") - F.col("_n")) & (F.col(e) < F.col("_upto")) for e in ("_low", "_high")}
    near = ranked.join(F.broadcast(targets), "_g").where(holds["_low"] | holds["_high"])  # few groups x probabilities
    ends = near.groupBy("_g", "p", "_part").agg(
        F.max(F.when(holds["_low"], F.col("_v"))).alias("low"), F.max(F.when(holds["_high"], F.col("_v"))).alias("high")
    )
    value = F.col("low") + (F.col("high") - F.col("low")) * F.col("_part")
    keys = [F.col("_g").alias(by)] if by else []
    return ends.select(*keys, F.col("p").alias("quantile"), value.alias("value"))


def log_hours_histogram(interactions: DataFrame, bins: int = HISTOGRAM_BINS, clip_at: float = HISTOGRAM_CLIP) -> DataFrame:
    """Equal-width bins of log1p(hours), hours clipped at a high quantile; the last edge is inclusive."""
    top = quantiles(interactions, "hours", [clip_at]).first()["value"]
    logged = interactions.select(F.log1p(clip(F.col("hours"), 0.0, top)).alias("x"))
    low, high = logged.agg(F.min("x"), F.max("x")).first()
    width = (high - low) / bins or 1.0
    number = F.least(F.floor((F.col("x") - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
    counted = logged.groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spine = interactions.sparkSession.range(bins).select(F.col("id").alias("bin"))
    filled = spine.join(counted, "bin", "left")
    return filled.select("bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("left_edge"), F.coalesce("n", F.lit(0)).alias("n"))


def label_counts(interactions: DataFrame) -> DataFrame:
    return interactions.groupBy("is_positive").agg(F.count(F.lit(1)).alias("n"))


def long_tail(interactions: DataFrame, key: str) -> DataFrame:
    """Rank and count of every key, most active first."""
    counts = interactions.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return global_rank(counts, [F.col("n").desc(), F.col(key).asc()], "rank")


def top_items(interactions: DataFrame, catalog: DataFrame, n: int = 10) -> DataFrame:
    counts = interactions.groupBy("item_id").agg(F.count(F.lit(1)).alias("interaction_count"))
    head = counts.orderBy(F.col("interaction_count").desc(), F.col("item_id").asc()).limit(n)
    return head.join(catalog.select("item_id", "title", "category"), "item_id", "left")


def monthly_counts(interactions: DataFrame) -> DataFrame:
    """Rows per month, labelled by month end; months without rows are present with 0."""
    months = interactions.groupBy(F.last_day("event_time").alias("month_end")).agg(F.count(F.lit(1)).alias("n"))
    span = months.agg(F.min("month_end").alias("first"), F.max("month_end").alias("last"))
    starts = F.sequence(F.trunc("first", "month"), F.trunc("last", "month"), F.expr("interval 1 month"))
    spine = span.select(F.explode(starts).alias("month")).select(F.last_day("month").alias("month_end"))
    return spine.join(months, "month_end", "left").select("month_end", F.coalesce("n", F.lit(0)).alias("interactions"))


def split_profile(labelled: DataFrame) -> DataFrame:
    """Rows, uniques, positive rate, median and p90 playtime and day range of every split."""
    facts = labelled.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("item_id").alias("unique_items"),
        positive_rate().alias("positive_rate"),
        F.to_date(F.min("event_time")).alias("start_day"),
        F.to_date(F.max("event_time")).alias("end_day"),
    )
    hours = quantiles(labelled, "hours", [0.5, 0.9], by="split").groupBy("split").agg(
        F.max(F.when(F.col("quantile") == 0.5, F.col("value"))).alias("median_hours"),
        F.max(F.when(F.col("quantile") == 0.9, F.col("value"))).alias("p90_hours"),
    )
    return facts.join(hours, "split")


def activity_quantiles(interactions: DataFrame, key: str, probabilities: Sequence[float] = ACTIVITY_QUANTILES) -> DataFrame:
    """Quantiles of the number of interactions per key."""
    counts = interactions.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return quantiles(counts, "n", probabilities)


def top_categories(catalog: DataFrame, n: int = TOP_CATEGORIES) -> DataFrame:
    counted = catalog.groupBy(F.coalesce("category", F.lit("Unknown")).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.col("n").desc(), F.col("category").asc()).limit(n)


def _pair_sums(columns: Sequence[str], shifts: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per partition: for every column pair the count and sums over rows where both are present."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, len(columns), len(columns)))
        for batch in batches:
            raw = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in columns])
            here = (~np.isnan(raw)).astype(np.float64)
            x = np.where(here > 0, raw - shifts, 0.0)
            total += np.stack([here.T @ here, x.T @ here, here.T @ x, (x * x).T @ here, here.T @ (x * x), x.T @ x])
        a, b = np.triu_indices(len(columns), 1)
        numbers = [pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), *[pa.array(t[a, b]) for t in total]]
        yield pa.RecordBatch.from_arrays(numbers, ["a", "b", "n", "x", "y", "xx", "yy", "xy"])

    return add_up


def correlated_pairs(rows: DataFrame, columns: Sequence[str], limit: float = CORRELATION_LIMIT) -> DataFrame:
    """Pearson correlation of every column pair, kept where its size exceeds ``limit``.

    Each pair uses the rows where both values are present. One pass reduces every partition
    to a handful of sums per pair by matrix products; only those are shuffled. Values are
    taken relative to the column mean, so large offsets do not cost precision. Constant
    columns have no correlation and drop out.
    """
    numbers = rows.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    with own_shuffles(rows.sparkSession):  # the rows are made twice
        means = numbers.agg(*[F.avg(f"`{c}`").alias(c) for c in columns]).first()
    shifts = np.array([m if m is not None else 0.0 for m in means])
    schema = "a int, b int, n double, x double, y double, xx double, yy double, xy double"
    sums = numbers.mapInArrow(_pair_sums(list(columns), shifts), schema).groupBy("a", "b")
    sums = sums.agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    spread_a = F.col("xx") - F.col("x") * F.col("x") / F.col("n")
    spread_b = F.col("yy") - F.col("y") * F.col("y") / F.col("n")
    shared = F.col("xy") - F.col("x") * F.col("y") / F.col("n")
    # A constant column leaves nothing but rounding noise of its own squares.
    varies = (spread_a > F.col("xx") * 1e-12) & (spread_b > F.col("yy") * 1e-12)
    named = F.array(*[F.lit(c) for c in columns])
    pairs = sums.where((F.col("n") > 1) & varies).select(
        F.get(named, F.col("a")).alias("feature_a"), F.get(named, F.col("b")).alias("feature_b"), (shared / F.sqrt(spread_a * spread_b)).alias("correlation")
    )
    return pairs.where(F.abs("correlation") > limit)
