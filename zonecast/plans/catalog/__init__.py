"""Registered queries with the SQL that states the same result."""

from zonecast.plans.catalog.base import oracle_sql, queries
from zonecast.plans.catalog import calibration, cleaning, demand, evaluation, features, marts, models, regressions, streams  # noqa: F401

__all__ = ["queries", "oracle_sql"]
