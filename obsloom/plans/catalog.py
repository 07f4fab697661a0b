"""All named queries."""

from obsloom.plans import (  # noqa: F401
    catalog_features,
    catalog_mining,
    catalog_models,
    catalog_reports,
    catalog_splits,
    catalog_storage,
)
from obsloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
