"""Queries bound to the test tables, each with the SQL that checks it."""

from lakeops.plans.registry import ORACLES, QUERIES
from lakeops.plans import (  # noqa: F401  (each module registers its queries)
    ingest,
    shaping,
    summaries,
    quality,
    changes,
    history,
    layouts,
    streams,
)

__all__ = ["ORACLES", "QUERIES"]
