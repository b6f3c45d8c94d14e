"""Queries over the given tables, one module per operator family."""

from plumbline.plans import (  # noqa: F401 - importing registers the queries
    aggregates,
    batches,
    joins,
    marts,
    projections,
    quality,
    review,
    scans,
    sets,
    text,
    windows,
)
from plumbline.plans.registry import ORACLES, QUERIES  # noqa: F401
