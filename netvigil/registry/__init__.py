"""Every operator as a named query over the given tables, with SQL to compare it to where there is some."""

from netvigil.registry import (  # noqa: F401
    aggregations,
    detection,
    filters,
    forecasting,
    lifecycle,
    monitoring,
    panels,
    streams,
    tables,
)
from netvigil.registry.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
