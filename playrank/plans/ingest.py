"""Queries over sources, sinks and cleaning."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playrank.operators.baselines import PopularityRecommender
from playrank.operators.interactions import positive_rate
from playrank.operators.splitting import split_boundaries
from playrank.plans.fixtures import catalog, interactions, prepared, raw_events, sql, table
from playrank.plans.registry import query, rounded
from playrank.session import materialize, new_path
from playrank.sources.cleaning import (
    INTERACTION_COLUMNS,
    build_catalog,
    canonical_events,
    load_events,
    load_games,
    minimal_catalog,
    valid_events,
)
from playrank.sources.literal_lines import REVIEW_SCHEMA, read_literal_lines
from playrank.sources.tables import (
    export_serving,
    read_export,
    read_results,
    read_split,
    read_tagged,
    save_splits,
    serving_tables,
    split_row_counts,
    write_summary,
)


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Play events as loosely typed raw records, with some missing and malformed fields.

    Written out first, as raw data is: the cleaning then reads a file and not this expression.
    """
    events = raw_events(spark, sf_dir)
    number = (F.col("text_length") / 10).cast("int")
    records = events.select(
        F.when((number == 7) & (F.col("item_id") % 10 == 0), F.lit("")).otherwise(F.col("user_id").cast("string")).alias("username"),
        F.when((number == 6) & (F.col("item_id") % 10 == 1), F.lit(None)).otherwise(F.col("item_id").cast("string")).alias("product_id"),
        F.when((number == 5) & (F.col("item_id") % 10 == 2), F.lit("soon")).otherwise(F.date_format("event_time", "yyyy-MM-dd")).alias("date"),
        F.when((number == 4) & (F.col("item_id") % 10 == 3), F.lit("n/a"))
        .when((number == 3) & (F.col("item_id") % 10 == 4), F.lit("-1.5"))
        .otherwise(F.col("hours").cast("string"))
        .alias("hours"),
        F.when(number != 2, F.repeat(F.lit("x"), F.col("text_length"))).alias("text"),
        F.col("early_access_review").alias("early_access"),
        F.col("products_owned").cast("string").alias("products"),
        F.when(number != 1, F.col("found_funny").cast("string")).alias("found_funny"),
        F.when(F.col("received_for_free"), F.lit("Product received for FREE")).alias("compensation"),
    )
    return materialize(records, "raw_reviews")


_RAW_SQL = """
    SELECT CASE WHEN ln = 7 AND item_id % 10 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS username,
           CASE WHEN ln = 6 AND item_id % 10 = 1 THEN NULL ELSE CAST(item_id AS VARCHAR) END AS product_id,
           CASE WHEN ln = 5 AND item_id % 10 = 2 THEN 'soon' ELSE strftime(event_time, '%Y-%m-%d') END AS date,
           CASE WHEN ln = 4 AND item_id % 10 = 3 THEN 'n/a' WHEN ln = 3 AND item_id % 10 = 4 THEN '-1.5'
                ELSE CAST(hours AS VARCHAR) END AS hours,
           CASE WHEN ln <> 2 THEN repeat('x', text_length) END AS text,
           early_access_review AS early_access, CAST(products_owned AS VARCHAR) AS products,
           CASE WHEN ln <> 1 THEN CAST(found_funny AS VARCHAR) END AS found_funny,
           CASE WHEN received_for_free THEN 'Product received for FREE' END AS compensation
    FROM (SELECT *, text_length // 10 AS ln FROM interactions_raw) r"""
_CANONICAL_SQL = """
    SELECT username AS user_id, product_id AS item_id, TRY_CAST(hours AS DOUBLE) AS hours,
           TRY_CAST(date AS TIMESTAMP) AS event_time, CAST(length(coalesce(text, '')) AS INT) AS text_length,
           coalesce(early_access, false) AS early_access_review, TRY_CAST(products AS DOUBLE) AS products_owned,
           TRY_CAST(coalesce(found_funny, '0') AS DOUBLE) AS found_funny,
           coalesce(contains(lower(compensation), 'free'), false) AS received_for_free
    FROM raw_reviews WHERE username <> '' AND product_id <> '' AND date <> ''"""
_VALID_SQL = "SELECT * FROM canonical WHERE event_time IS NOT NULL AND hours >= 0"
_LATEST_SQL = """
    SELECT * EXCLUDE (rn), hours >= 1.0 AS is_positive FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY event_time DESC, hours DESC,
            text_length DESC, CAST(early_access_review AS INT) DESC, CAST(received_for_free AS INT) DESC) AS rn
        FROM valid) v WHERE rn = 1"""


@query(
    "src1_literal_lines",
    sql(
        "interactions_raw",
        """SELECT CAST(user_id AS VARCHAR) AS username, CAST(item_id AS VARCHAR) AS product_id,
                  strftime(event_time, '%Y-%m-%d') AS date, round(hours, 6) AS hours, text_length AS chars,
                  early_access_review AS early_access, received_for_free AS free
           FROM interactions_raw""",
    ),
)
def literal_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "literal_lines")
    boolean = lambda c: F.when(F.col(c), F.lit("True")).otherwise(F.lit("False"))
    line = F.concat(
        F.lit("{u'username': u'"), F.col("user_id").cast("string"),
        F.lit("', u'product_id': u'"), F.col("item_id").cast("string"),
        F.lit("', u'date': u'"), F.date_format("event_time", "yyyy-MM-dd"),
        F.lit("', u'hours': "), F.col("hours").cast("string"),
        F.lit(", u'text': u'It\\'s "), F.repeat(F.lit("x"), F.col("text_length") - 5),
        F.lit("', u'early_access': "), boolean("early_access_review"),
        F.when(F.col("received_for_free"), F.lit(", u'compensation': u'Product received for free'}")).otherwise(F.lit("}")),
    )
    raw_events(spark, sf_dir).select(line.alias("value")).write.option("compression", "gzip").text(path)
    rows = read_literal_lines(spark, path, REVIEW_SCHEMA)
    return rounded(
        rows.select(
            "username",
            "product_id",
            "date",
            "hours",
            F.length("text").alias("chars"),
            "early_access",
            F.coalesce(F.lower("compensation").contains("free"), F.lit(False)).alias("free"),
        ),
        "hours",
    )


@query(
    "src2_load_games",
    """WITH raw AS (
         SELECT p.*, copy, CASE WHEN p_size = 49 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS id
         FROM part p, (VALUES (0), (1)) c(copy) WHERE copy = 0 OR p_partkey % 3 = 0),
       last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY copy DESC) AS rn
                               FROM raw WHERE id IS NOT NULL) r WHERE rn = 1)
       SELECT id AS item_id,
              CASE WHEN p_size <> 48 THEN CASE WHEN copy = 1 THEN concat(p_name, ' II') ELSE p_name END
                   WHEN p_partkey % 2 = 0 THEN concat('app ', p_name) ELSE concat('Steam app ', id) END AS title,
              CASE WHEN p_size < 30 THEN p_type WHEN p_size < 40 THEN p_brand ELSE 'Unknown' END AS category,
              CASE WHEN p_size < 30 THEN concat(p_type, '|', p_brand) ELSE '' END AS genres,
              CASE WHEN p_size < 40 THEN p_brand ELSE '' END AS tags,
              CASE WHEN p_size % 7 <> 0 THEN CAST(make_date(1995 + p_size % 25, 1, 1) AS TIMESTAMP) END AS release_date,
              p_brand AS developer, 'self' AS publisher,
              CASE WHEN p_size % 5 <> 0 THEN round(p_retailprice, 6) END AS price,
              p_size <= 5 AS early_access_item, concat('/app/', id) AS store_url
       FROM last""",
)
def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    part = table(spark, sf_dir, "part").withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    part = part.where((F.col("copy") == 0) | (F.col("p_partkey") % 3 == 0))
    key = F.col("p_partkey").cast("string")
    name = F.when(F.col("copy") == 1, F.concat("p_name", F.lit(" II"))).otherwise(F.col("p_name"))
    raw = part.select(
        F.when(size != 49, key).alias("id"),
        F.when(size != 48, name).alias("title"),
        F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("app "), "p_name")).alias("app_name"),
        F.when(size < 30, F.array("p_type", "p_brand")).alias("genres"),
        F.when(size < 40, F.array("p_brand")).otherwise(F.array().cast("array<string>")).alias("tags"),
        F.when(size % 7 == 0, F.lit("coming soon")).otherwise(F.make_date((1995 + size % 25).cast("int"), F.lit(1), F.lit(1)).cast("string")).alias("release_date"),
        F.col("p_brand").alias("developer"),
        F.lit("self").alias("publisher"),
        F.when(size % 5 == 0, F.lit("Free")).otherwise(F.col("p_retailprice").cast("string")).alias("price"),
        (size <= 5).alias("early_access"),
        F.concat(F.lit("/app/"), key).alias("url"),
        F.col("copy").alias("_line"),
    )
    return rounded(load_games(raw), "price")


@query(
    "src3_load_events",
    sql("interactions_raw", "SELECT * FROM latest", raw_reviews=_RAW_SQL, canonical=_CANONICAL_SQL, valid=_VALID_SQL, latest=_LATEST_SQL),
)
def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_events(raw_reviews(spark, sf_dir))


@query(
    "prj1_required_fields",
    sql(
        "interactions_raw",
        """SELECT count(*) AS kept, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items FROM canonical""",
        raw_reviews=_RAW_SQL,
        canonical=_CANONICAL_SQL,
    ),
)
def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_events(raw_reviews(spark, sf_dir)).agg(
        F.count(F.lit(1)).alias("kept"), F.count_distinct("user_id").alias("users"), F.count_distinct("item_id").alias("items")
    )


@query("prj3_valid_rows", sql("interactions_raw", "SELECT * FROM valid", raw_reviews=_RAW_SQL, canonical=_CANONICAL_SQL, valid=_VALID_SQL))
def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_events(canonical_events(raw_reviews(spark, sf_dir)))


@query("prj4_canonical_schema", sql("interactions_raw", "SELECT * FROM canonical", raw_reviews=_RAW_SQL, canonical=_CANONICAL_SQL))
def canonical_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_events(raw_reviews(spark, sf_dir))


_COLUMNS = ", ".join(INTERACTION_COLUMNS)


@query("src4_split_scan", sql("validation", f"SELECT {_COLUMNS} FROM validation"))
def split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_split(spark, prepared(spark, sf_dir).path, "validation")


@query("src5_pruned_tagged_scan", sql("test", "SELECT user_id, item_id, hours, event_time, is_positive, 'test' AS split FROM test"))
def pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["user_id", "item_id", "hours", "event_time", "is_positive"]
    return read_tagged(spark, prepared(spark, sf_dir).path, "test", columns)


@query("src6_row_counts", sql("split_rows", "SELECT split, count(*) AS rows FROM split_rows GROUP BY split"))
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_row_counts(spark, prepared(spark, sf_dir).path)


@query(
    "src7_results_rows",
    sql(
        "split_rows",
        """SELECT split, 'all' AS model, count(DISTINCT user_id) AS users,
                  round(avg(CAST(is_positive AS INT)), 6) AS positive_rate, round(avg(hours), 6) AS mean_hours
           FROM split_rows GROUP BY split""",
    ),
)
def results_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = prepared(spark, sf_dir).labelled.groupBy("split").agg(
        F.lit("all").alias("model"), F.count_distinct("user_id").alias("users"), positive_rate().alias("positive_rate"), F.avg("hours").alias("mean_hours")
    )
    entry = F.array(F.struct("model", "users", "positive_rate", "mean_hours"))
    one = facts.groupBy().pivot("split", ["train", "validation", "test"]).agg(F.first(entry))
    path = new_path(spark, "results")
    one.coalesce(1).write.json(path)
    return rounded(read_results(spark, path, ["positive_rate", "mean_hours"]), "positive_rate", "mean_hours")


@query(
    "snk1_saved_splits",
    sql(
        "split_rows",
        """SELECT split, count(*) AS n, round(sum(hours), 6) AS hours, sum(text_length) AS chars, count(products_owned) AS with_products
           FROM split_rows GROUP BY split""",
    ),
)
def saved_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    path = new_path(spark, "saved")
    save_splits(data.labelled, data.catalog, path)
    parts = [read_split(spark, path, s).withColumn("split", F.lit(s)) for s in ("train", "validation", "test")]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rounded(
        rows.groupBy("split").agg(
            F.count(F.lit(1)).alias("n"), F.sum("hours").alias("hours"), F.sum("text_length").alias("chars"), F.count("products_owned").alias("with_products")
        ),
        "hours",
    )


@query(
    "snk2_summary_files",
    sql(
        "split_rows",
        """SELECT split, count(*) AS rows, round(avg(CAST(is_positive AS INT)), 6) AS positive_rate, f AS format
           FROM split_rows, (VALUES ('csv'), ('json')) v(f) GROUP BY split, f""",
    ),
)
def summary_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "summary")
    write_summary(split_boundaries(prepared(spark, sf_dir).labelled), path)
    schema = "split string, rows bigint, start_time string, end_time string, positive_rate double"
    csv = spark.read.schema(schema).option("header", True).csv(os.path.join(path, "csv")).withColumn("format", F.lit("csv"))
    json = spark.read.schema(schema).json(os.path.join(path, "json")).withColumn("format", F.lit("json"))
    return rounded(csv.unionByName(json).select("split", "rows", "positive_rate", "format"), "positive_rate")


@query(
    "snk3_serving_export",
    sql(
        "train test catalog",
        """SELECT 'users' AS name, count(*) AS n, count(DISTINCT user_id) AS keys, min(t) AS first_time, max(t) AS last_time
           FROM (SELECT user_id, min(event_time) AS t FROM (SELECT * FROM train UNION ALL SELECT * FROM test) r GROUP BY user_id) u
           UNION ALL SELECT 'items', count(*), count(DISTINCT item_id), NULL, NULL FROM catalog
           UNION ALL SELECT 'interactions', 2 * count(*), 2 * count(*), min(event_time), max(event_time) FROM test""",
    ),
)
def serving_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the first sent twice: keyed tables stay as they are, a new batch's interactions are appended."""
    data = prepared(spark, sf_dir)
    path = new_path(spark, "serving")
    tables = serving_tables(data.train, data.test, data.catalog)
    for batch in ("first", "first", "second"):
        export_serving(tables, path, batch)
    keys = {"users": ("user_id", "created_at"), "items": ("item_id", None), "interactions": ("id", "event_time")}
    parts = [
        read_export(spark, path, n).agg(
            F.lit(n).alias("name"),
            F.count(F.lit(1)).alias("n"),
            F.count_distinct(key).alias("keys"),
            (F.min(time) if time else F.lit(None).cast("timestamp_ntz")).alias("first_time"),
            (F.max(time) if time else F.lit(None).cast("timestamp_ntz")).alias("last_time"),
        )
        for n, (key, time) in keys.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "snk4_model_tables",
    sql(
        "train",
        """SELECT item_id, popularity, row_number() OVER (ORDER BY popularity DESC, item_id) AS position
           FROM (SELECT item_id, count(*) AS popularity FROM train WHERE is_positive GROUP BY item_id) c""",
    ),
)
def model_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved, loaded and written out by the loaded model."""
    path = new_path(spark, "model")
    PopularityRecommender().fit(prepared(spark, sf_dir).train).save(path)
    return PopularityRecommender.load(spark, path).ranked


@query(
    "jn1_catalog_enrichment",
    sql(
        "interactions catalog",
        """SELECT o.item_id, coalesce(c.title, concat('Steam app ', o.item_id)) AS title, coalesce(c.category, 'Unknown') AS category,
                  c.genres, c.price, concat('https://cdn.akamai.steamstatic.com/steam/apps/', o.item_id, '/header.jpg') AS image_url
           FROM (SELECT item_id FROM interactions UNION SELECT -item_id FROM interactions) o LEFT JOIN catalog c ON o.item_id = c.item_id""",
    ),
)
def enriched_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item once more under an id without metadata, so that the defaults show."""
    seen = interactions(spark, sf_dir).select("item_id")
    built = build_catalog(seen.unionByName(seen.select((-F.col("item_id")).alias("item_id"))), catalog(spark, sf_dir))
    return built.select("item_id", "title", "category", "genres", "price", "image_url")


@query(
    "prj5_templates",
    sql(
        "catalog",
        """SELECT item_id, concat('https://cdn.akamai.steamstatic.com/steam/apps/', item_id, '/header.jpg') AS image_url,
                  CASE WHEN item_id % 5 = 0 THEN concat('Steam app ', item_id) ELSE title END AS title FROM catalog""",
    ),
)
def templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from playrank.sources.cleaning import image_url, title_for

    items = catalog(spark, sf_dir)
    title = F.when(F.col("item_id") % 5 != 0, F.col("title")).otherwise(F.lit(""))
    return items.select("item_id", image_url(F.col("item_id")).alias("image_url"), title_for(F.col("item_id"), title).alias("title"))


@query(
    "sv8_minimal_catalog",
    sql("interactions", "SELECT DISTINCT item_id, concat('Game ', item_id) AS title, 'Unknown' AS category, '' AS image_url FROM interactions"),
)
def stand_in_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minimal_catalog(interactions(spark, sf_dir))
