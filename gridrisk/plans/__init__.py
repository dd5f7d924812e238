"""All registered queries of the library."""

from __future__ import annotations

from gridrisk.plans import exposure_queries, hazard_queries, keyed_queries, lookup_queries, rule_queries, source_queries, spatial_queries, table_queries, zonal_queries  # noqa: F401  (they register themselves)
from gridrisk.plans.registry import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
