"""The registered queries. Importing the package fills the registry."""

from playrank.plans import basics, ingest, models, ranking, reports, retrieval  # noqa: F401
from playrank.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
