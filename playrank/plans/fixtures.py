"""Views of the given tables in the shape the operators take, for Spark and for the SQL oracle."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playrank.operators.relational import deal, parts_for
from playrank.operators.similarity import mean_item_vectors
from playrank.operators.splitting import time_based_split
from playrank.session import SESSION_CONF, drop_tables, folder_stamp, materialize, new_path, own_shuffles, recording, shared_dir
from playrank.sources.cleaning import latest_events
from playrank.sources.tables import read_catalog, read_split, read_splits, save_splits

VECTOR_DIM = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as play events: customer = user, part = item, quantity = playtime."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    parts = parts_for(spark, lines.count())  # from the footers
    lines, orders = deal(lines, parts, "l_orderkey"), deal(orders, parts, "o_orderkey")
    number = F.col("l_linenumber")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        (F.col("l_quantity") / F.lit(10.0)).alias("hours"),
        F.col("o_orderdate").alias("event_time"),
        (number * 10).alias("text_length"),
        (F.col("l_returnflag") == "R").alias("early_access_review"),
        F.when(number != 1, number.cast("double")).alias("products_owned"),
        (number % 3).cast("double").alias("found_funny"),
        (F.col("l_discount") == 0).alias("received_for_free"),
    )


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_events(raw_events(spark, sf_dir))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as items; some have no category."""
    year = (F.lit(1995) + F.col("p_size") % 25).cast("int")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        F.when(F.col("p_size") != 50, F.col("p_type")).alias("category"),
        F.concat("p_type", F.lit("|"), "p_brand").alias("genres"),
        F.replace("p_name", F.lit(" "), F.lit("|")).alias("tags"),
        F.make_date(year, F.lit(1), F.lit(1)).alias("release_date"),
        F.col("p_brand").alias("developer"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_size") <= 5).alias("early_access_item"),
        F.concat(F.lit("https://example.org/"), F.col("p_partkey").cast("string")).alias("image_url"),
    )


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("vec_id"))
    vectors = table(spark, sf_dir, "embeddings").join(parts, "vec_id", "left_semi")
    return vectors.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vec"))


def clock_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream as interactions with a time of day."""
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        (F.col("value") / F.lit(24.0)).alias("hours"),
        F.col("ts").alias("event_time"),
        "event_type",
    )


@dataclass
class Prepared:
    """Saved splits and catalog, read back as every later step reads them."""

    path: str
    labelled: DataFrame
    train: DataFrame
    validation: DataFrame
    test: DataFrame
    catalog: DataFrame


_saved: dict[tuple, tuple[str, tuple | None]] = {}  # path of the saved tables, and their stamp when they were written


def prepared(spark: SparkSession, sf_dir: str) -> Prepared:
    """Split and save the interactions once per application and given tables, then read the saved tables.

    They are saved anew when the shared folder was changed or cleared in between, or when other tables stand at the path.
    """
    spark.conf.set("spark.sql.session.timeZone", SESSION_CONF["spark.sql.session.timeZone"])
    given = [folder_stamp(spark, os.path.join(sf_dir, f"{t}.parquet")) for t in ("lineitem", "orders", "part")]
    key = (spark.sparkContext.applicationId, shared_dir(spark), sf_dir, *given)
    path, stamp = _saved.get(key, ("", None))
    if stamp is None or folder_stamp(spark, path) != stamp:
        path = new_path(spark, "splits")
        with recording() as made:
            latest = materialize(interactions(spark, sf_dir), "interactions")  # the split reads it several times
            with own_shuffles(spark):
                save_splits(time_based_split(latest), catalog(spark, sf_dir), path)
        drop_tables(spark, made)
        _saved[key] = path, folder_stamp(spark, path)
    splits = {s: read_split(spark, path, s) for s in ("train", "validation", "test")}
    return Prepared(path, read_splits(spark, path), catalog=read_catalog(spark, path), **splits)


def user_vectors(data: Prepared, vectors: DataFrame) -> DataFrame:
    """Unit mean of the vectors of each user's positive training items."""
    return mean_item_vectors(data.train.where("is_positive"), vectors, VECTOR_DIM)


# The same views as SQL text for the oracle, in dependency order.
SQL_VIEWS = {
    "interactions_raw": """
        SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, l.l_quantity / CAST(10 AS DOUBLE) AS hours,
               o.o_orderdate AS event_time, l.l_linenumber * 10 AS text_length,
               l.l_returnflag = 'R' AS early_access_review,
               CASE WHEN l.l_linenumber = 1 THEN NULL ELSE CAST(l.l_linenumber AS DOUBLE) END AS products_owned,
               CAST(l.l_linenumber % 3 AS DOUBLE) AS found_funny, l.l_discount = 0 AS received_for_free
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "interactions": """
        SELECT user_id, item_id, hours, event_time, hours >= 1.0 AS is_positive, text_length,
               early_access_review, products_owned, found_funny, received_for_free
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id, item_id
                ORDER BY event_time DESC, hours DESC, text_length DESC,
                         CAST(early_access_review AS INT) DESC, CAST(received_for_free AS INT) DESC) AS rn
              FROM interactions_raw) x
        WHERE rn = 1""",
    "split_rows": """
        SELECT i.* EXCLUDE (rn, n),
               CASE WHEN rn <= floor(floor(n * 0.8) * 0.9) THEN 'train'
                    WHEN rn <= floor(n * 0.8) THEN 'validation' ELSE 'test' END AS split
        FROM (SELECT *, row_number() OVER (ORDER BY event_time, user_id, item_id) AS rn,
                     count(*) OVER () AS n FROM interactions) i""",
    "train": "SELECT * EXCLUDE (split) FROM split_rows WHERE split = 'train'",
    "validation": "SELECT * EXCLUDE (split) FROM split_rows WHERE split = 'validation'",
    "test": "SELECT * EXCLUDE (split) FROM split_rows WHERE split = 'test'",
    "catalog": """
        SELECT p_partkey AS item_id, p_name AS title, CASE WHEN p_size = 50 THEN NULL ELSE p_type END AS category,
               concat(p_type, '|', p_brand) AS genres, replace(p_name, ' ', '|') AS tags,
               make_date(1995 + p_size % 25, 1, 1) AS release_date, p_brand AS developer,
               p_retailprice AS price, p_size <= 5 AS early_access_item,
               concat('https://example.org/', p_partkey) AS image_url
        FROM part""",
    "item_vectors": """
        SELECT vec_id AS item_id, embedding AS vec FROM embeddings WHERE vec_id IN (SELECT p_partkey FROM part)""",
    "event_interactions": """
        SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
               value / CAST(24 AS DOUBLE) AS hours, ts AS event_time, event_type FROM events""",
    "user_mean": """
        SELECT user_id, list(m ORDER BY d) AS vec FROM (
            SELECT t.user_id, u.d, avg(u.x) AS m
            FROM train t JOIN item_vectors v ON t.item_id = v.item_id,
                 LATERAL (SELECT unnest(range(1, 65)) AS d, CAST(unnest(v.vec) AS DOUBLE) AS x) u
            WHERE t.is_positive GROUP BY t.user_id, u.d) g
        GROUP BY user_id""",
    "user_vectors": """
        SELECT user_id, list_transform(vec, lambda x: x / sqrt(list_dot_product(vec, vec))) AS vec FROM user_mean""",
}

_NEEDS = {
    "interactions": ["interactions_raw"],
    "split_rows": ["interactions"],
    "train": ["split_rows"],
    "validation": ["split_rows"],
    "test": ["split_rows"],
    "user_mean": ["train", "item_vectors"],
    "user_vectors": ["user_mean"],
}


def sql(needs: str, body: str, **extra: str) -> str:
    """Oracle text: the named views and any extra ones as CTEs, then the query."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        for inner in _NEEDS.get(name, []):
            add(inner)
        wanted.add(name)

    for name in needs.split():
        add(name)
    views = [(n, t) for n, t in SQL_VIEWS.items() if n in wanted] + list(extra.items())
    if not views:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({t})" for n, t in views) + "\n" + body
