"""Queries over scalar functions, joins, aggregates, ordering and set operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playrank.functions.scalars import (
    clip,
    days_between,
    discount,
    feature_name_column,
    log_price,
    mentions,
    positive_label,
    sigmoid,
    text_length,
    to_number,
)
from playrank.functions.vectors import dot, l2_normalize, squared_distance
from playrank.operators.candidates import group_share, item_mean_hours, label_pairs, most_played
from playrank.operators.exploration import correlated_pairs, dataset_summary, long_tail, monthly_counts, quantiles, top_items
from playrank.operators.features import align, category_affinity, item_categories, top_values, user_category_counts
from playrank.operators.interactions import ground_truth, group_layout, group_sizes, history, item_sets, positive_rate
from playrank.operators.relational import global_rank, lookup_join, top_k_per_group
from playrank.operators.sampling import sample_rows
from playrank.operators.splitting import most_recent, split_boundaries, time_based_split
from playrank.plans.fixtures import catalog, clock_events, interactions, item_vectors, prepared, raw_events, sql, table
from playrank.plans.registry import query, rounded
from playrank.session import materialize

# ---------------------------------------------------------------- projections and functions


@query("prj2_positive_label", sql("interactions_raw", "SELECT is_positive, count(*) AS n FROM (SELECT hours >= 2.5 AS is_positive FROM interactions_raw) x GROUP BY 1"))
def label(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_events(spark, sf_dir).select(positive_label(F.col("hours"), 2.5).alias("is_positive"))
    return rows.groupBy("is_positive").agg(F.count(F.lit(1)).alias("n"))


@query(
    "fn1_string_functions",
    sql(
        "catalog",
        """SELECT item_id, length(title) AS chars, lower(title) AS lowered, coalesce(contains(lower(title), 'ring'), false) AS has_ring,
                  string_split(genres, '|')[1] AS first_genre, array_to_string(string_split(tags, '|'), '|') AS joined,
                  concat('genre_', replace(replace(genres, ' ', '_'), '&', 'and')) AS feature FROM catalog""",
    ),
)
def strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog(spark, sf_dir).select(
        "item_id",
        text_length(F.col("title")).alias("chars"),
        F.lower("title").alias("lowered"),
        mentions(F.col("title"), "ring").alias("has_ring"),
        F.try_element_at(F.split("genres", "[|]"), F.lit(1)).alias("first_genre"),
        F.array_join(F.split("tags", "[|]"), "|").alias("joined"),
        feature_name_column("genre", F.col("genres")).alias("feature"),
    )


@query(
    "fn2_date_functions",
    sql(
        "event_interactions",
        """SELECT user_id, item_id, event_time, event_type, hour(event_time) AS hour, year(event_time) AS year, CAST(event_time AS DATE) AS day,
                  round(date_diff('microsecond', TIMESTAMP '2024-01-01', event_time) / 86400000000.0, 6) AS days,
                  TRY_CAST(concat('2024-01-', event_type) AS TIMESTAMP) AS parsed FROM event_interactions""",
    ),
)
def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    rows = clock_events(spark, sf_dir).select(
        "user_id",
        "item_id",
        "event_time",
        "event_type",
        F.hour("event_time").alias("hour"),
        F.year("event_time").alias("year"),
        F.to_date("event_time").alias("day"),
        days_between(F.col("event_time"), start).alias("days"),
        F.concat(F.lit("2024-01-"), "event_type").try_cast("timestamp_ntz").alias("parsed"),
    )
    return rounded(rows, "days")


@query(
    "fn3_math_functions",
    sql(
        "interactions_raw",
        """SELECT user_id, item_id, event_time, text_length, round(ln(1 + hours), 6) AS log_hours, round(sin(hours), 6) AS sine, round(cos(hours), 6) AS cosine,
                  round(1 / log2(text_length + 1), 6) AS discount, round(1 / (1 + exp(-hours)), 6) AS logistic,
                  least(greatest(hours, 1.0), 3.0) AS clipped, round(hours, 0) AS whole FROM interactions_raw""",
    ),
)
def maths(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.col("hours")
    rows = raw_events(spark, sf_dir).select(
        "user_id",
        "item_id",
        "event_time",
        "text_length",
        log_price(h).alias("log_hours"),
        F.sin(h).alias("sine"),
        F.cos(h).alias("cosine"),
        discount(F.col("text_length")).alias("discount"),
        sigmoid(h).alias("logistic"),
        clip(h, 1.0, 3.0).alias("clipped"),
        F.round(h, 0).alias("whole"),
    )
    return rounded(rows, "log_hours", "sine", "cosine", "discount", "logistic")


@query(
    "fn4_null_handling",
    sql(
        "interactions_raw",
        """SELECT user_id, item_id, event_time, text_length, coalesce(products_owned, 0) AS filled, coalesce(products_owned, hours) AS borrowed,
                  TRY_CAST(CASE WHEN text_length = 20 THEN 'many' ELSE CAST(text_length AS VARCHAR) END AS DOUBLE) AS coerced,
                  CASE WHEN products_owned > 3 THEN hours / products_owned ELSE 1.0 END AS chosen FROM interactions_raw""",
    ),
)
def nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("text_length") == 20, F.lit("many")).otherwise(F.col("text_length").cast("string"))
    return raw_events(spark, sf_dir).select(
        "user_id",
        "item_id",
        "event_time",
        "text_length",
        F.coalesce("products_owned", F.lit(0.0)).alias("filled"),
        F.coalesce("products_owned", "hours").alias("borrowed"),
        to_number(text).alias("coerced"),
        F.when(F.col("products_owned") > 3, F.col("hours") / F.col("products_owned")).otherwise(F.lit(1.0)).alias("chosen"),
    )


@query(
    "fn5_vector_functions",
    sql(
        "item_vectors",
        """SELECT a.item_id, round(CAST(a.vec[1] AS DOUBLE), 6) AS first_value, round(list_dot_product(v, w), 6) AS product,
                  round(list_dot_product(v, v) + list_dot_product(w, w) - 2 * list_dot_product(v, w), 6) AS distance,
                  round(list_extract(v, 2) / sqrt(list_dot_product(v, v)), 6) AS unit_second
           FROM (SELECT item_id, vec, CAST(vec AS DOUBLE[]) AS v FROM item_vectors) a
           JOIN (SELECT item_id - 1 AS item_id, CAST(vec AS DOUBLE[]) AS w FROM item_vectors) b ON a.item_id = b.item_id""",
    ),
)
def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector against the next item's."""
    left = item_vectors(spark, sf_dir)
    right = left.select((F.col("item_id") - 1).alias("item_id"), F.col("vec").alias("next"))
    rows = left.join(right, "item_id").select(
        "item_id",
        F.try_element_at("vec", F.lit(1)).alias("first_value"),
        dot(F.col("vec"), F.col("next")).alias("product"),
        squared_distance(F.col("vec"), F.col("next")).alias("distance"),
        l2_normalize(F.col("vec"))[1].alias("unit_second"),
    )
    return rounded(rows, "first_value", "product", "distance", "unit_second")


# ---------------------------------------------------------------- joins

_ITEM_STATS = "SELECT item_id, count(*) AS popularity, avg(hours) AS mean_hours FROM train GROUP BY item_id"


@query(
    "jn2_stats_with_catalog",
    sql(
        "train catalog",
        """SELECT s.item_id, popularity, round(mean_hours, 9) AS mean_hours, coalesce(category, 'Unknown') AS category,
                  CAST(coalesce(early_access_item, false) AS INT) AS early FROM stats s LEFT JOIN catalog c ON s.item_id = c.item_id""",
        stats=_ITEM_STATS,
    ),
)
def stats_with_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    stats = data.train.groupBy("item_id").agg(F.count(F.lit(1)).alias("popularity"), F.avg("hours").alias("mean_hours"))
    joined = stats.join(data.catalog.select("item_id", "category", "early_access_item"), "item_id", "left")
    rows = joined.select(
        "item_id",
        "popularity",
        "mean_hours",
        F.coalesce("category", F.lit("Unknown")).alias("category"),
        F.coalesce("early_access_item", F.lit(False)).cast("int").alias("early"),
    )
    return rounded(rows, "mean_hours", places=9)


@query(
    "jn3_user_and_item_lookup",
    sql(
        "train test",
        """SELECT t.user_id, t.item_id, n AS user_rows, round(user_hours, 9) AS user_hours, popularity, round(mean_hours, 9) AS mean_hours
           FROM test t LEFT JOIN (SELECT user_id, count(*) AS n, avg(hours) AS user_hours FROM train GROUP BY user_id) u ON t.user_id = u.user_id
           LEFT JOIN stats s ON t.item_id = s.item_id""",
        stats=_ITEM_STATS,
    ),
)
def user_and_item_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    users = data.train.groupBy("user_id").agg(F.count(F.lit(1)).alias("user_rows"), F.avg("hours").alias("user_hours"))
    stats = data.train.groupBy("item_id").agg(F.count(F.lit(1)).alias("popularity"), F.avg("hours").alias("mean_hours"))
    rows = data.test.select("user_id", "item_id").join(users, "user_id", "left")
    return rounded(lookup_join(rows, materialize(stats, "item_stats"), "item_id", "user_id"), "user_hours", "mean_hours", places=9)


_COUNTS = """SELECT t.user_id, coalesce(c.category, 'Unknown') AS category, count(*) AS cat_count
             FROM train t LEFT JOIN catalog c ON t.item_id = c.item_id GROUP BY 1, 2"""
_AFFINITY = """SELECT user_id, category, cat_count / CAST(sum(cat_count) OVER (PARTITION BY user_id) AS DOUBLE) AS affinity FROM cat_counts"""


@query(
    "jn4_composite_key",
    sql(
        "train test catalog",
        """SELECT t.user_id, t.item_id, coalesce(c.category, 'Unknown') AS category, round(coalesce(a.affinity, 0.0), 6) AS affinity
           FROM test t LEFT JOIN catalog c ON t.item_id = c.item_id
           LEFT JOIN affinity a ON a.user_id = t.user_id AND a.category = coalesce(c.category, 'Unknown')""",
        cat_counts=_COUNTS,
        affinity=_AFFINITY,
    ),
)
def composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    placed = lookup_join(data.test.select("user_id", "item_id"), item_categories(data.catalog), "item_id", "user_id")
    rows = placed.join(category_affinity(data.train, data.catalog), ["user_id", "category"], "left")
    value = F.coalesce("user_category_affinity", F.lit(0.0)).alias("affinity")
    return rounded(rows.select("user_id", "item_id", "category", value), "affinity")


@query(
    "jn5_counts_to_totals",
    sql(
        "train catalog",
        """SELECT k.user_id, k.category, k.cat_count AS n, round(k.cat_count / CAST(t.total AS DOUBLE), 6) AS share
           FROM cat_counts k JOIN (SELECT user_id, count(*) AS total FROM train GROUP BY user_id) t ON k.user_id = t.user_id""",
        cat_counts=_COUNTS,
    ),
)
def counts_to_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    placed = lookup_join(data.train.select("user_id", "item_id"), item_categories(data.catalog), "item_id", "user_id")
    return rounded(group_share(placed, ["user_id", "category"], "user_id"), "share")


@query(
    "jn6_lookup_with_default",
    sql(
        "train test",
        """SELECT t.user_id, t.item_id, round(coalesce(s.mean_hours, 0.0), 9) AS mean_hours
           FROM (SELECT user_id, item_id FROM test UNION ALL SELECT user_id, -item_id FROM test) t LEFT JOIN stats s ON t.item_id = s.item_id""",
        stats=_ITEM_STATS,
    ),
)
def lookup_with_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair once more under an id that no item has, so that the default shows."""
    data = prepared(spark, sf_dir)
    pairs = data.test.select("user_id", "item_id")
    pairs = pairs.unionByName(pairs.select("user_id", (-F.col("item_id")).alias("item_id")))
    rows = lookup_join(pairs, materialize(item_mean_hours(data.train), "item_means"), "item_id", "user_id")
    return rounded(rows.select("user_id", "item_id", F.coalesce("item_avg_hours", F.lit(0.0)).alias("mean_hours")), "mean_hours", places=9)


_USER_SAMPLE = """SELECT user_id FROM (SELECT DISTINCT user_id FROM train) u ORDER BY md5(concat_ws('|', '42', user_id)), user_id LIMIT 200"""


@query("jn7_semi_join_sampled_users", sql("train", "SELECT user_id, item_id, hours FROM train WHERE user_id IN (SELECT user_id FROM chosen)", chosen=_USER_SAMPLE))
def semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = prepared(spark, sf_dir).train
    chosen = sample_rows(materialize(train.select("user_id").distinct(), "users"), ["user_id"], 200)
    return train.select("user_id", "item_id", "hours").join(chosen, "user_id", "left_semi")


@query(
    "jn8_anti_join_seen",
    sql("train test", "SELECT user_id, item_id + 1 AS item_id FROM test t WHERE NOT EXISTS (SELECT 1 FROM train s WHERE s.user_id = t.user_id AND s.item_id = t.item_id + 1)"),
)
def anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The neighbours of the held-out items, less what the user has already seen."""
    data = prepared(spark, sf_dir)
    offered = data.test.select("user_id", (F.col("item_id") + 1).alias("item_id"))
    return offered.join(history(data.train), ["user_id", "item_id"], "left_anti")


@query(
    "jn9_label_membership",
    sql(
        "train test",
        """SELECT s.user_id, s.item_id + 1 AS item_id, t.user_id IS NOT NULL AS is_positive FROM train s
           LEFT JOIN (SELECT DISTINCT user_id, item_id FROM test WHERE is_positive) t ON t.user_id = s.user_id AND t.item_id = s.item_id + 1""",
    ),
)
def label_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    pairs = data.train.select("user_id", (F.col("item_id") + 1).alias("item_id"))
    return label_pairs(pairs, ground_truth(data.test))


@query(
    "jn10_align_to_ids",
    sql(
        "train test",
        """SELECT t.user_id, coalesce(n, 0) AS n, round(coalesce(h, 0), 9) AS mean_hours FROM (SELECT DISTINCT user_id FROM test) t
           LEFT JOIN (SELECT user_id, count(*) AS n, avg(hours) AS h FROM train GROUP BY user_id) s ON s.user_id = t.user_id""",
    ),
)
def align_to_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    stats = data.train.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.avg("hours").alias("mean_hours"))
    return rounded(align(data.test, stats, "user_id"), "mean_hours", places=9)


@query(
    "jn11_top_items_display",
    sql(
        "interactions catalog",
        """SELECT p.item_id, interaction_count, title, category FROM (SELECT item_id, count(*) AS interaction_count FROM interactions
             GROUP BY item_id ORDER BY interaction_count DESC, item_id LIMIT 10) p LEFT JOIN catalog c ON p.item_id = c.item_id""",
    ),
)
def top_items_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    return top_items(data.labelled, data.catalog)


# ---------------------------------------------------------------- aggregates

_USER_STATS = """SELECT user_id, count(item_id) AS n, round(avg(hours), 9) AS mean_hours, count(DISTINCT item_id) AS items,
                        round(avg(CAST(is_positive AS INT)), 9) AS positive_rate, round(sum(hours), 6) AS total FROM train GROUP BY user_id"""


@query("ag1_user_aggregate", sql("train", _USER_STATS))
def user_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = prepared(spark, sf_dir).train.groupBy("user_id").agg(
        F.count("item_id").alias("n"),
        F.avg("hours").alias("mean_hours"),
        F.count_distinct("item_id").alias("items"),
        positive_rate().alias("positive_rate"),
        F.sum("hours").alias("total"),
    )
    return rounded(rounded(stats, "mean_hours", "positive_rate", places=9), "total")


@query("ag2_item_aggregate", sql("train", "SELECT item_id, count(user_id) AS n, round(avg(hours), 9) AS mean_hours, round(avg(CAST(is_positive AS INT)), 9) AS positive_rate FROM train GROUP BY item_id"))
def item_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = prepared(spark, sf_dir).train.groupBy("item_id").agg(
        F.count("user_id").alias("n"), F.avg("hours").alias("mean_hours"), positive_rate().alias("positive_rate")
    )
    return rounded(stats, "mean_hours", "positive_rate", places=9)


@query("ag3_sample_deviation", sql("train", "SELECT user_id, round(coalesce(stddev_samp(hours), 0), 6) AS deviation FROM train GROUP BY user_id"))
def sample_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = prepared(spark, sf_dir).train.groupBy("user_id").agg(F.coalesce(F.stddev_samp("hours"), F.lit(0.0)).alias("deviation"))
    return rounded(stats, "deviation")


@query("ag4_two_key_count", sql("train catalog", "SELECT * FROM cat_counts", cat_counts=_COUNTS))
def two_key_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    return user_category_counts(data.train, data.catalog)


@query("ag5_max_and_first", sql("interactions", "SELECT user_id, max(event_time) AS latest, arg_min(hours, (event_time, item_id)) AS first_hours FROM interactions GROUP BY user_id"))
def max_and_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, sf_dir).labelled.groupBy("user_id").agg(
        F.max("event_time").alias("latest"), F.min_by("hours", F.struct("event_time", "item_id")).alias("first_hours")
    )


@query(
    "ag6_sum_and_rank",
    sql(
        "interactions_raw",
        """SELECT user_id, item_id, round(total_hours, 6) AS total_hours, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY total_hours DESC, item_id) AS rank
           FROM (SELECT user_id, item_id, round(sum(hours), 6) AS total_hours FROM interactions_raw GROUP BY user_id, item_id) t) r WHERE rank <= 3""",
    ),
)
def sum_and_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours are whole tenths; rounding the sums keeps equal totals equal on both engines."""
    rows = table(spark, sf_dir, "lineitem").count()  # from the footers; a line has one order
    return rounded(most_played(raw_events(spark, sf_dir), 3, places=6, rows=rows), "total_hours")


@query(
    "ag7_value_counts",
    sql(
        "catalog",
        """SELECT value, count(*) AS n FROM (SELECT unnest(string_split(tags, '|')) AS value FROM catalog WHERE tags IS NOT NULL) t
           GROUP BY value ORDER BY n DESC, value LIMIT 20""",
    ),
)
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_values(prepared(spark, sf_dir).catalog, "tags", 20, "|")


@query(
    "ag8_exact_quantiles",
    sql(
        "interactions",
        """SELECT p AS quantile, round(v, 6) AS value FROM (SELECT unnest([0.25, 0.5, 0.75, 0.9, 0.95, 0.99]) AS p,
             unnest(quantile_cont(hours, [0.25, 0.5, 0.75, 0.9, 0.95, 0.99])) AS v FROM interactions) q""",
    ).replace("p AS quantile", "CAST(p AS DOUBLE) AS quantile"),
)
def exact_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quantiles(prepared(spark, sf_dir).labelled, "hours", [0.25, 0.5, 0.75, 0.9, 0.95, 0.99]), "value")


_SUMMARY = """
    SELECT count(*) AS interactions, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items, sum(CAST(is_positive AS INT)) AS positive_interactions,
           round(avg(CAST(is_positive AS INT)), 6) AS positive_rate, min(event_time) AS start_date, max(event_time) AS end_date,
           (SELECT count(*) FROM catalog) AS catalog_items, (SELECT count(*) FROM catalog WHERE category IS NOT NULL) AS items_with_known_metadata,
           round(1 - count(*) / (CAST(count(DISTINCT user_id) AS DOUBLE) * count(DISTINCT item_id)), 6) AS sparsity, CAST(1.0 AS DOUBLE) AS positive_threshold_hours
    FROM {source}"""


@query("ag9_global_counts", sql("train validation test catalog", _SUMMARY.format(source="whole"), whole="SELECT * FROM train UNION ALL SELECT * FROM validation UNION ALL SELECT * FROM test"))
def global_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over all three saved splits."""
    data = prepared(spark, sf_dir)
    return rounded(dataset_summary(data.train.unionByName(data.validation).unionByName(data.test), data.catalog), "positive_rate", "sparsity")


@query("ex1_dataset_summary", sql("interactions catalog", _SUMMARY.format(source="interactions")))
def whole_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    return rounded(dataset_summary(data.labelled, data.catalog), "positive_rate", "sparsity")


@query("ag10_item_sets", sql("train", "SELECT user_id, array_to_string(list_sort(list(DISTINCT item_id)), ',') AS items, count(DISTINCT item_id) AS n FROM train GROUP BY user_id"))
def sets_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = item_sets(history(prepared(spark, sf_dir).train))
    text = F.array_join(F.col("items").cast("array<string>"), ",")
    return sets.select("user_id", text.alias("items"), F.size("items").alias("n"))


_MONTHS = """
    SELECT last_day(CAST(m AS DATE)) AS month_end, coalesce(n, 0) AS interactions
    FROM (SELECT unnest(generate_series((SELECT date_trunc('month', min(event_time)) FROM {source}),
                                        (SELECT max(event_time) FROM {source}), INTERVAL 1 MONTH)) AS m) s
    LEFT JOIN (SELECT date_trunc('month', event_time) AS k, count(*) AS n FROM {source} GROUP BY 1) c ON c.k = s.m"""


@query(
    "ag11_monthly_resample",
    sql("interactions", _MONTHS.format(source="sparse"), sparse="SELECT event_time FROM interactions UNION ALL SELECT max(event_time) + INTERVAL 7 MONTH FROM interactions"),
)
def monthly_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows and one more half a year later, so that empty months appear."""
    times = prepared(spark, sf_dir).labelled.select("event_time")
    later = times.agg((F.max("event_time") + F.expr("INTERVAL 7 MONTH")).alias("event_time"))
    return monthly_counts(times.unionByName(later))


@query("ex5_monthly_counts", sql("interactions", _MONTHS.format(source="interactions")))
def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_counts(prepared(spark, sf_dir).labelled)


@query(
    "ag12_pairwise_correlation",
    sql(
        "interactions",
        """SELECT * FROM (
             SELECT 'hours' AS feature_a, 'text_length' AS feature_b, round(corr(hours, text_length), 6) AS correlation FROM interactions
             UNION ALL SELECT 'hours', 'products_owned', round(corr(hours, products_owned), 6) FROM interactions
             UNION ALL SELECT 'hours', 'found_funny', round(corr(hours, found_funny), 6) FROM interactions
             UNION ALL SELECT 'text_length', 'products_owned', round(corr(text_length, products_owned), 6) FROM interactions
             UNION ALL SELECT 'text_length', 'found_funny', round(corr(text_length, found_funny), 6) FROM interactions
             UNION ALL SELECT 'products_owned', 'found_funny', round(corr(products_owned, found_funny), 6) FROM interactions) c
           WHERE abs(correlation) > 0.01""",
    ),
)
def pairwise_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepared(spark, sf_dir).labelled
    pairs = correlated_pairs(rows, ["hours", "text_length", "products_owned", "found_funny"], 0.01)
    return rounded(pairs, "correlation")


@query("ag13_population_deviation", sql("train", "SELECT round(avg(n), 6) AS mean_rows, round(stddev_pop(n), 6) AS deviation FROM (SELECT count(*) AS n FROM train GROUP BY user_id) c"))
def population_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = group_sizes(prepared(spark, sf_dir).train)
    return rounded(sizes.agg(F.avg("group_size").alias("mean_rows"), F.stddev_pop("group_size").alias("deviation")), "mean_rows", "deviation")


# ---------------------------------------------------------------- ordering, limits and sets


@query("rel1_latest_wins", sql("interactions", "SELECT * FROM interactions"))
def latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions(spark, sf_dir)


@query(
    "rel2_most_recent",
    sql("interactions", "SELECT user_id, item_id, hours, event_time FROM interactions ORDER BY event_time DESC, user_id DESC, item_id DESC LIMIT 5000"),
)
def recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most recent 5,000 rows: the operator caps the table by design."""
    return most_recent(prepared(spark, sf_dir).labelled.select("user_id", "item_id", "hours", "event_time"), 5000)


@query("rel3_time_split", sql("split_rows", "SELECT user_id, item_id, event_time, split FROM split_rows"))
def time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = interactions(spark, sf_dir).select("user_id", "item_id", "event_time")
    return time_based_split(materialize(rows, "interactions"))


@query(
    "rel4_split_boundaries",
    sql(
        "split_rows",
        """SELECT split, count(*) AS rows, min(event_time) AS start_time, max(event_time) AS end_time,
                  round(avg(CAST(is_positive AS INT)), 6) AS positive_rate FROM split_rows GROUP BY split""",
    ),
)
def boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(split_boundaries(prepared(spark, sf_dir).labelled), "positive_rate")


@query(
    "rel5_top_k_per_user",
    sql("train", "SELECT user_id, item_id, hours, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY hours DESC, item_id) AS rank FROM train) r WHERE rank <= 5"),
)
def top_k_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepared(spark, sf_dir).train.select("user_id", "item_id", "hours")
    return top_k_per_group(rows, "user_id", [F.col("hours").desc(), F.col("item_id").asc()], 5)


@query("rel6_global_top_k", sql("train", "SELECT item_id, count(*) AS n FROM train GROUP BY item_id ORDER BY n DESC, item_id LIMIT 20"))
def global_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = prepared(spark, sf_dir).train.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col("item_id").asc()).limit(20)


@query("rel7_multi_key_sort", sql("catalog", "SELECT item_id, early_access_item, price, row_number() OVER (ORDER BY early_access_item DESC, price DESC, item_id) AS place FROM catalog"))
def multi_key_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("early_access_item").desc(), F.col("price").desc(), F.col("item_id").asc()]
    return global_rank(prepared(spark, sf_dir).catalog.select("item_id", "early_access_item", "price"), order, "place")


@query("rel8_union_splits", sql("train validation", "SELECT user_id, item_id, hours FROM train UNION ALL SELECT user_id, item_id, hours FROM validation"))
def union_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    return data.train.unionByName(data.validation).select("user_id", "item_id", "hours")


@query(
    "rel9_set_difference",
    sql(
        "train validation test",
        """SELECT user_id, item_id FROM (SELECT * FROM train UNION ALL SELECT * FROM validation UNION ALL SELECT * FROM test) every
           EXCEPT SELECT user_id, item_id FROM train EXCEPT SELECT user_id, item_id FROM test WHERE is_positive""",
    ),
)
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs less those seen in training, less the held-out positives."""
    data = prepared(spark, sf_dir)
    pairs = history(data.train, data.validation, data.test)
    for gone in (data.train.select("user_id", "item_id"), ground_truth(data.test)):
        pairs = pairs.join(gone, ["user_id", "item_id"], "left_anti")
    return pairs


@query("rel10_set_intersection", sql("train test", "SELECT count(*) AS common FROM (SELECT item_id FROM test WHERE is_positive INTERSECT SELECT item_id FROM train) c"))
def set_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out positive items that the training catalog holds."""
    data = prepared(spark, sf_dir)
    wanted = data.test.where("is_positive").select("item_id").distinct()
    return wanted.join(data.train.select("item_id").distinct(), "item_id", "left_semi").agg(F.count(F.lit(1)).alias("common"))


@query("rel11_rank_frequency", sql("interactions", "SELECT item_id, n, row_number() OVER (ORDER BY n DESC, item_id) AS rank FROM (SELECT item_id, count(*) AS n FROM interactions GROUP BY item_id) c"))
def rank_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long_tail(prepared(spark, sf_dir).labelled, "item_id")


@query(
    "rel12_group_layout",
    sql(
        "train",
        """SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY item_id) AS position, count(*) OVER (PARTITION BY user_id) AS group_size FROM train""",
    ),
)
def contiguous_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = group_layout(prepared(spark, sf_dir).train.select("user_id", "item_id"))
    by_user = W.partitionBy("user_id")
    return rows.select(
        "user_id",
        "item_id",
        F.row_number().over(by_user.orderBy("item_id")).alias("position"),
        F.count(F.lit(1)).over(by_user).alias("group_size"),
    )
