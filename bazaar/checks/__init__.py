"""Query and oracle pairs: every operator on the driver's tables, next to its SQL."""

from bazaar.checks import (  # noqa: F401
    aggregates,
    analytics,
    conformance,
    dates,
    feed_files,
    filters,
    html,
    joins,
    nested,
    shapes,
    sinks,
    sources,
    streams,
    text,
    windows,
)
from bazaar.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
