"""All queries of the deliberation engine and their SQL."""

from . import choice, groups, intake_queries, models, more, roundtrips  # noqa: F401  they register their queries
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
