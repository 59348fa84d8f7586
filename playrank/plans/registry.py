"""Every query with its oracle text, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without oracle text only rows and schema can be checked."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name!r}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Round the named columns so that summation order cannot show.

    Means over small groups can end exactly in a 5 at the seventh place; they take 9 places.
    """
    return df.withColumns({c: F.round(F.col(c).cast("double"), places) for c in columns})
