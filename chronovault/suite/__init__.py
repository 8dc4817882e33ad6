"""Registered queries over the driver's tables, each with the SQL it must agree with."""

from . import (  # noqa: F401
    aggregates, catalog, expressions, filters, ingest, joins, series, sinks, store, streams, versions,
)
from .registry import ORACLES, QUERIES  # noqa: F401
