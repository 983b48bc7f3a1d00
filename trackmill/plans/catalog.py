"""All registered queries."""

from trackmill.plans import catalog_flights, catalog_joins, catalog_models, catalog_samples  # noqa: F401
from trackmill.plans.registry import ORACLES, QUERIES, oracles

__all__ = ["ORACLES", "QUERIES", "oracles"]
