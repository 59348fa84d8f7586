"""Ranking features and model inputs, all computed from the training split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playrank.functions.scalars import clip, cyclic_hour, days_between, feature_name, log_price, scaled_year
from playrank.operators.interactions import positive_rate
from playrank.operators.relational import global_rank, lookup_join, shuffled_join, skewed_join
from playrank.session import materialize

UNKNOWN = "Unknown"

# The numeric ranking features, in model order.
NUMERIC_FEATURES = [
    "user_activity_count",
    "user_avg_hours",
    "user_distinct_items",
    "user_positive_rate",
    "user_total_hours",
    "user_avg_text_length",
    "item_popularity",
    "item_avg_hours",
    "item_positive_rate",
    "item_avg_text_length",
    "item_is_early_access",
    "user_category_affinity",
    "user_item_hours_vs_avg",
    "days_since_last",
    "hour_sin",
    "hour_cos",
]


def user_features(train: DataFrame) -> DataFrame:
    return train.groupBy("user_id").agg(
        F.count("item_id").alias("user_activity_count"),
        F.avg("hours").alias("user_avg_hours"),
        F.count_distinct("item_id").alias("user_distinct_items"),
        positive_rate().alias("user_positive_rate"),
        F.sum("hours").alias("user_total_hours"),
        F.avg("text_length").alias("user_avg_text_length"),
    )


def item_features(train: DataFrame, catalog: DataFrame) -> DataFrame:
    """Item aggregates with category and early-access flag; missing metadata gets defaults."""
    stats = train.groupBy("item_id").agg(
        F.count("user_id").alias("item_popularity"),
        F.avg("hours").alias("item_avg_hours"),
        positive_rate().alias("item_positive_rate"),
        F.avg("text_length").alias("item_avg_text_length"),
    )
    joined = stats.join(catalog.select("item_id", "category", "early_access_item"), "item_id", "left")
    return joined.select(
        *stats.columns,
        F.coalesce("category", F.lit(UNKNOWN)).alias("category"),
        F.coalesce(F.col("early_access_item").cast("int"), F.lit(0)).alias("item_is_early_access"),
    )


def item_categories(catalog: DataFrame) -> DataFrame:
    return catalog.select("item_id", F.coalesce("category", F.lit(UNKNOWN)).alias("category"))


def user_category_counts(train: DataFrame, catalog: DataFrame) -> DataFrame:
    """Training rows per (user, category); items without metadata count as Unknown."""
    placed = lookup_join(train.select("user_id", "item_id"), item_categories(catalog), "item_id", "user_id")
    category = F.coalesce("category", F.lit(UNKNOWN))
    return placed.groupBy("user_id", category.alias("category")).agg(F.count(F.lit(1)).alias("cat_count"))


def category_affinity(train: DataFrame, catalog: DataFrame) -> DataFrame:
    """Share of the user's training rows that fall into each category.

    The user total is a window sum over the per-category counts, so no second pass and no
    join to a totals table is needed.
    """
    counts = user_category_counts(train, catalog)
    total = F.sum("cat_count").over(W.partitionBy("user_id"))
    return counts.select("user_id", "category", (F.col("cat_count") / total).alias("user_category_affinity"))


def playtime_ratio(hours: Column, user_mean: Column) -> Column:
    """Hours against the user's mean; 1.0 where the mean is missing or not positive."""
    return F.when(user_mean > 0, F.coalesce(hours, user_mean) / user_mean).otherwise(F.lit(1.0))


def days_since(event_time: Column, last: Column) -> Column:
    """Days since the last training event within [0, 365]; 365 when unknown."""
    return clip(F.coalesce(days_between(event_time, last), F.lit(365.0)), 0, 365)


def last_events(train: DataFrame) -> DataFrame:
    return train.groupBy("user_id").agg(F.max("event_time").alias("last_event_time"))


def category_vocabulary(rows: DataFrame) -> DataFrame:
    """(place, value): the category values in sorted order; NULL counts as Unknown. Written, however many there are."""
    values = rows.select(F.coalesce("category", F.lit(UNKNOWN)).alias("value")).distinct()
    return materialize(global_rank(values, [F.col("value").asc()], "place").select((F.col("place") - 1).alias("place"), "value"), "vocabulary")


def with_category_index(rows: DataFrame, vocabulary: DataFrame, spread: str = "user_id") -> DataFrame:
    """Add ``category_index``, the value's place in the vocabulary; an unseen value has the place behind the last.

    The index stands for one 0/1 column per known value, all zero for an unseen one: ``one_hot_vector`` makes it a sparse
    vector, and the plan stays the same however many values there are.
    """
    places = vocabulary.select(F.col("value").alias("_value"), "place")
    joined = lookup_join(rows.withColumn("_value", F.coalesce("category", F.lit(UNKNOWN))), places, "_value", spread, write=True)
    return joined.withColumn("category_index", F.coalesce("place", F.lit(vocabulary.count()))).drop("_value", "place")


def one_hot_vector(rows: DataFrame, categories: int, column: str = "category_vector") -> DataFrame:
    """Add the sparse vector of ``categories`` 0/1 entries that ``category_index`` stands for."""
    nominal = {"ml_attr": {"type": "nominal", "num_vals": categories, "name": "category"}}
    placed = rows.withColumn("_index", F.col("category_index").cast("double").alias("_index", metadata=nominal))
    encoder = OneHotEncoder(inputCol="_index", outputCol=column, handleInvalid="keep", dropLast=True)  # the place kept for unseen values is the last
    return encoder.fit(placed).transform(placed).drop("_index")


def user_profiles(rows: DataFrame, catalog: DataFrame, told: DataFrame | None = None) -> DataFrame:
    """User features, the last event time and a category -> share map, in one pass.

    The rows are summed per (user, category) first and per user from there. An item has one
    category, so distinct items add up. The map has an entry per category, never per row. ``told`` is as in ``lookup_join``.
    """
    columns = rows.select("user_id", "item_id", "hours", "is_positive", "text_length", "event_time")
    placed = lookup_join(columns, item_categories(catalog), "item_id", "user_id", told=told).withColumns(
        {"category": F.coalesce("category", F.lit(UNKNOWN)), "positive": F.col("is_positive").cast("int")}
    )
    measured = ("hours", "positive", "text_length")
    parts = placed.groupBy("user_id", "category").agg(
        F.count("item_id").alias("rows"),
        F.count_distinct("item_id").alias("items"),
        *[F.sum(c).alias(f"sum_{c}") for c in measured],
        *[F.count(c).alias(f"n_{c}") for c in measured],
        F.max("event_time").alias("last"),
    )
    mean = lambda c: F.sum(f"sum_{c}") / F.sum(f"n_{c}")
    users = parts.groupBy("user_id").agg(
        F.sum("rows").alias("user_activity_count"),
        mean("hours").alias("user_avg_hours"),
        F.sum("items").alias("user_distinct_items"),
        mean("positive").alias("user_positive_rate"),
        F.sum("sum_hours").alias("user_total_hours"),
        mean("text_length").alias("user_avg_text_length"),
        F.max("last").alias("last_event_time"),
        F.map_from_entries(F.collect_list(F.struct("category", "rows"))).alias("_counts"),
    )
    shares = F.transform_values("_counts", lambda _, n: n / F.col("user_activity_count"))
    return users.withColumn("category_share", shares).drop("_counts")


def cross_and_temporal(candidates: DataFrame, train: DataFrame, catalog: DataFrame, items: DataFrame) -> DataFrame:
    """Candidates with user, item, cross and temporal features and the category.

    ``items`` are the item features of ``train``. Only training rows of users who have
    candidates are aggregated. Item features come from the lookup; then the candidates are
    shuffled once, by user, and the category affinity comes from the user's own map.
    """
    asked = candidates.select("user_id").distinct()
    users = user_profiles(shuffled_join(train, asked, "user_id", "left_semi"), catalog, told=train)
    joined = shuffled_join(lookup_join(candidates, items, "item_id", "user_id", told=candidates), users, "user_id", "left")  # a user's map is never sent on
    hour_sin, hour_cos = cyclic_hour(F.col("event_time"))
    return joined.withColumns(
        {
            "user_category_affinity": F.coalesce(F.try_element_at("category_share", F.col("category")), F.lit(0.0)),
            "user_item_hours_vs_avg": playtime_ratio(F.col("hours"), F.col("user_avg_hours")),
            "days_since_last": days_since(F.col("event_time"), F.col("last_event_time")),
            "hour_sin": hour_sin,
            "hour_cos": hour_cos,
        }
    )


def build_features(candidates: DataFrame, train: DataFrame, catalog: DataFrame, vocabulary: DataFrame | None = None) -> tuple[DataFrame, list[str], DataFrame]:
    """(features, numeric feature names, vocabulary). The names are an explicit list, so a context
    column that happens to be among the candidates never becomes a feature. The category is given
    as ``category_index``, its place in the vocabulary table."""
    candidates = materialize(candidates, "candidates")  # read for its users and for its rows
    items = materialize(item_features(train, catalog), "item_features")  # counted, joined and listed
    rows = cross_and_temporal(candidates, train, catalog, items)
    if vocabulary is None:
        vocabulary = category_vocabulary(items)
    keys = ["user_id", "item_id", "event_time", "hours", "is_positive"]
    encoded = with_category_index(rows.select(*keys, *NUMERIC_FEATURES, "category"), vocabulary)
    return encoded.select(*keys, *NUMERIC_FEATURES, "category_index"), list(NUMERIC_FEATURES), vocabulary


def align(ids: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """``rows`` for exactly the given ids; absent ids and values become zero."""
    wide = ids.select(key).distinct().join(rows, key, "left")
    return wide.fillna(0, subset=[c for c in rows.columns if c != key])


# The user-side inputs of the two-tower model, in model order.
USER_TOWER_FEATURES = [
    "feat_count",
    "feat_avg_hours",
    "feat_std_hours",
    "feat_products",
    "feat_text_len",
    "feat_cat_div",
    "feat_avg_price",
    "feat_ea_rate",
]


def user_tower_features(train: DataFrame, catalog: DataFrame, users: DataFrame) -> DataFrame:
    """Eight numbers per user: play statistics and the variety, price and age of what is played."""
    meta = catalog.select("item_id", "category", "price", F.col("early_access_item").cast("int").alias("early"))
    columns = train.select("user_id", "item_id", "hours", "products_owned", "text_length")
    rows = lookup_join(columns, meta, "item_id", "user_id")
    stats = rows.groupBy("user_id").agg(
        F.count("item_id").alias("feat_count"),
        F.avg("hours").alias("feat_avg_hours"),
        F.coalesce(F.stddev_samp("hours"), F.lit(0.0)).alias("feat_std_hours"),
        F.avg("products_owned").alias("feat_products"),
        F.avg("text_length").alias("feat_text_len"),
        F.count_distinct("category").alias("feat_cat_div"),
        F.avg("price").alias("feat_avg_price"),
        F.avg("early").alias("feat_ea_rate"),
    )
    doubles = stats.select("user_id", *[F.col(c).cast("double").alias(c) for c in USER_TOWER_FEATURES])
    return align(users, doubles, "user_id")


def top_values(rows: DataFrame, column: str, n: int, split_on: str | None = None) -> DataFrame:
    """The ``n`` most frequent values with their counts; ties by value."""
    values = F.explode(F.split(column, f"[{split_on}]")) if split_on else F.col(column)
    counted = rows.where(F.col(column).isNotNull()).select(values.alias("value")).groupBy("value")
    return counted.agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col("value").asc()).limit(n)


def contains_value(joined: Column, value: str, match: str = "substring") -> Column:
    """1.0 where a ``|``-joined string holds the value, as a substring or as a whole token."""
    text = F.coalesce(joined, F.lit(""))
    if match == "substring":
        return text.contains(value).cast("double")
    if match == "token":
        return F.array_contains(F.split(text, "[|]"), value).cast("double")
    raise ValueError(f"unknown match {match!r}")


def item_tower_features(
    train: DataFrame, catalog: DataFrame, items: DataFrame, n_genres: int = 15, n_tags: int = 20, match: str = "substring"
) -> tuple[DataFrame, list[str]]:
    """(item features, names): play statistics, genre and tag flags, price, year, developer size."""
    genres = [r["value"] for r in top_values(catalog, "genres", n_genres, "|").collect()]  # n_genres rows
    tags = [r["value"] for r in top_values(catalog, "tags", n_tags, "|").collect()]  # n_tags rows
    # The feature names here and below are the item-side inputs of the two-tower model, in model order.
    stats = train.groupBy("item_id").agg(
        F.count("user_id").cast("double").alias("feat_popularity"),
        F.avg("hours").alias("feat_avg_hours"),
        positive_rate().alias("feat_pos_rate"),
        F.avg("text_length").alias("feat_text_len"),
    )
    sizes = catalog.groupBy("developer").agg(F.count(F.lit(1)).alias("dev_count"))
    described = catalog.select("item_id", "genres", "tags", "price", "release_date", "early_access_item", "developer")
    described = skewed_join(stats.join(described, "item_id", "left"), sizes, "developer", "item_id")
    flags = [contains_value(F.col("genres"), g, match).alias(feature_name("genre", g)) for g in genres]
    flags += [contains_value(F.col("tags"), t, match).alias(feature_name("tag", t)) for t in tags]
    rows = described.select(
        *stats.columns,
        *flags,
        log_price(F.col("price")).alias("feat_log_price"),
        scaled_year(F.col("release_date")).alias("feat_release_year"),
        F.coalesce(F.col("early_access_item").cast("double"), F.lit(0.0)).alias("feat_early_access"),
        (clip(F.coalesce("dev_count", F.lit(1)).cast("double"), upper=500) / F.lit(500.0)).alias("feat_dev_pop"),
    )
    return align(items, rows, "item_id"), [c for c in rows.columns if c != "item_id"]
