"""Registered queries over the trade tables, each with an independent SQL statement."""

from levyscan.checks import catalog_cases, catalog_rules, catalog_tables  # noqa: F401
from levyscan.checks.registry import ORACLES, QUERIES  # noqa: F401
