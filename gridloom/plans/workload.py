"""All registered queries."""

from gridloom.plans import (  # noqa: F401
    audit_queries,
    axis_queries,
    catalog_queries,
    derive_queries,
    prepare_queries,
    regrid_queries,
    series_queries,
    vertical_queries,
)
from gridloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
