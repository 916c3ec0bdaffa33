"""All oracle SQL keyed like ``dqspark.plans.catalog``."""

from __future__ import annotations

from .checker_sql import CHECKER
from .checks_sql import CHECKS
from .constraints_sql import CONSTRAINTS
from .fixtures_sql import with_tables
from .maintenance_sql import MAINTENANCE
from .metrics_sql import METRICS


def all_oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for group in (CHECKS, CHECKER, CONSTRAINTS, METRICS, MAINTENANCE):
        for name, (tables, body) in group.items():
            out[name] = with_tables(tables, body)
    return out
