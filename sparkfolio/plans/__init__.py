"""Registered queries over the driver tables, each with its oracle SQL.

Importing this package imports every plan module, which fills the registry.
"""

from sparkfolio.plans.registry import ORACLE, QUERIES, query  # noqa: F401
from sparkfolio.plans import engine, activity, kpi, series, churn, files, sparse, ordered  # noqa: F401,E402
