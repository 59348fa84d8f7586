"""From raw records to saved splits in one call."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from playrank.operators.exploration import dataset_summary
from playrank.operators.splitting import most_recent, split_boundaries, time_based_split
from playrank.session import materialize
from playrank.sources.cleaning import POSITIVE_HOURS, build_catalog, load_events, load_games
from playrank.sources.literal_lines import GAME_SCHEMA, REVIEW_SCHEMA, read_literal_lines
from playrank.sources.tables import read_catalog, read_splits, save_splits, write_summary


def prepare(events: DataFrame, games: DataFrame, path: str, max_rows: int | None = None) -> None:
    """Write splits, catalog and both summaries under ``path``.

    The cap and the split each read their input several times, so the de-duplicated events
    are written once and not computed again. ``max_rows=None`` keeps all rows.
    """
    spark = events.sparkSession
    kept = materialize(events, "events")
    if max_rows is not None and kept.count() > max_rows:
        kept = materialize(most_recent(kept, max_rows), "recent")
    save_splits(time_based_split(kept), build_catalog(kept, games), path)
    saved = read_splits(spark, path)
    write_summary(split_boundaries(saved), os.path.join(path, "split_summary"))
    write_summary(dataset_summary(saved, read_catalog(spark, path)), os.path.join(path, "data_summary"))


def prepare_files(spark: SparkSession, reviews: str, games: str, path: str, threshold: float = POSITIVE_HOURS, max_rows: int | None = None) -> None:
    """The same from gzipped literal-line files."""
    events = load_events(read_literal_lines(spark, reviews, REVIEW_SCHEMA), threshold)
    prepare(events, load_games(read_literal_lines(spark, games, GAME_SCHEMA)), path, max_rows)
