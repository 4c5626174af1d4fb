"""All registered queries: name -> job on the sample tables, with its SQL."""

from harborline.catalog import (  # noqa: F401
    aggregates,
    composites,
    documents,
    joins,
    projections,
    quality,
    scalars,
    sinks,
    sources,
    streams,
    vendor,
    windows,
)
from harborline.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
