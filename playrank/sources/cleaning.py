"""Raw event and metadata records to the canonical tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playrank.functions.scalars import mentions, positive_label, present, text_length, to_number
from playrank.operators.relational import latest_per_key

# The column list and constants every saved split must have.
INTERACTION_COLUMNS = [
    "user_id",
    "item_id",
    "hours",
    "event_time",
    "is_positive",
    "text_length",
    "early_access_review",
    "products_owned",
    "found_funny",
    "received_for_free",
]
POSITIVE_HOURS = 1.0
UNKNOWN_CATEGORY = "Unknown"
FALLBACK_TITLE_PREFIX = "Steam app "
IMAGE_URL_PREFIX = "https://cdn.akamai.steamstatic.com/steam/apps/"
IMAGE_URL_SUFFIX = "/header.jpg"


def latest_first(time: str = "event_time") -> list[Column]:
    """Newest first; the payload breaks ties, so the order is total up to equal rows."""
    return [
        F.col(time).desc(),
        F.col("hours").desc(),
        F.col("text_length").desc(),
        F.col("early_access_review").cast("int").desc(),
        F.col("received_for_free").cast("int").desc(),
    ]


def canonical_events(raw: DataFrame) -> DataFrame:
    """Rename and type the raw review fields; rows without user, item or date are dropped."""
    return raw.where(present("username", "product_id", "date")).select(
        F.col("username").alias("user_id"),
        F.col("product_id").alias("item_id"),
        to_number(F.col("hours")).alias("hours"),
        F.col("date").try_cast("timestamp_ntz").alias("event_time"),
        text_length(F.col("text")).alias("text_length"),
        F.coalesce(F.col("early_access"), F.lit(False)).alias("early_access_review"),
        to_number(F.col("products")).alias("products_owned"),
        to_number(F.coalesce(F.col("found_funny"), F.lit("0"))).alias("found_funny"),
        mentions(F.col("compensation"), "free").alias("received_for_free"),
    )


def valid_events(events: DataFrame) -> DataFrame:
    """Drop rows with a null key, time or playtime, and negative playtime."""
    return events.dropna(subset=["user_id", "item_id", "event_time", "hours"]).where(F.col("hours") >= 0)


def latest_events(events: DataFrame, threshold: float = POSITIVE_HOURS) -> DataFrame:
    """Latest row per (user, item), labelled by playtime."""
    latest = latest_per_key(events, ["user_id", "item_id"], latest_first())
    return latest.withColumn("is_positive", positive_label(F.col("hours"), threshold)).select(*INTERACTION_COLUMNS)


def load_events(raw: DataFrame, threshold: float = POSITIVE_HOURS) -> DataFrame:
    return latest_events(valid_events(canonical_events(raw)), threshold)


def title_for(item_id: Column, *titles: Column) -> Column:
    """First non-empty title, else a generated one."""
    usable = [F.when(t != "", t) for t in titles]
    return F.coalesce(*usable, F.concat(F.lit(FALLBACK_TITLE_PREFIX), item_id.cast("string")))


def image_url(item_id: Column) -> Column:
    return F.concat(F.lit(IMAGE_URL_PREFIX), item_id.cast("string"), F.lit(IMAGE_URL_SUFFIX))


def load_games(raw: DataFrame) -> DataFrame:
    """Metadata with one row per item: the last line wins, in the order of files and of lines in a file."""
    place = [F.col(c) for c in ("_source", "_block", "_line") if c in raw.columns]
    first_genre = F.try_element_at("genres", F.lit(1))
    first_tag = F.try_element_at("tags", F.lit(1))
    games = raw.where(F.col("id").isNotNull()).select(
        F.col("id").alias("item_id"),
        title_for(F.col("id"), F.col("title"), F.col("app_name")).alias("title"),
        F.coalesce(first_genre, first_tag, F.lit(UNKNOWN_CATEGORY)).alias("category"),
        F.coalesce(F.array_join("genres", "|"), F.lit("")).alias("genres"),
        F.coalesce(F.array_join("tags", "|"), F.lit("")).alias("tags"),
        F.col("release_date").try_cast("timestamp_ntz").alias("release_date"),
        "developer",
        "publisher",
        to_number(F.col("price")).alias("price"),
        F.coalesce(F.col("early_access"), F.lit(False)).alias("early_access_item"),
        F.col("url").alias("store_url"),
        F.struct(*place).alias("_order"),
    )
    return latest_per_key(games, ["item_id"], [F.col("_order").desc()]).drop("_order")


def build_catalog(interactions: DataFrame, games: DataFrame) -> DataFrame:
    """Observed items with their metadata, defaults filled, and an image URL."""
    observed = interactions.select("item_id").distinct()
    joined = observed.join(games, "item_id", "left")
    return joined.withColumns(
        {
            "title": F.coalesce("title", F.concat(F.lit(FALLBACK_TITLE_PREFIX), F.col("item_id").cast("string"))),
            "category": F.coalesce("category", F.lit(UNKNOWN_CATEGORY)),
            "image_url": image_url(F.col("item_id")),
        }
    )


def minimal_catalog(interactions: DataFrame) -> DataFrame:
    """Stand-in catalog from observed ids when no metadata exists."""
    return interactions.select("item_id").distinct().select(
        "item_id",
        F.concat(F.lit("Game "), F.col("item_id").cast("string")).alias("title"),
        F.lit(UNKNOWN_CATEGORY).alias("category"),
        F.lit("").alias("image_url"),
    )
