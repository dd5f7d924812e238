"""Registered queries of the library's own operators, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Named subqueries that the SQL twins share.
CTES = {
    "cells": "SELECT l_suppkey AS cell, CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month, l_linenumber AS model, l_returnflag AS hazard, l_linestatus AS scenario, sum(l_quantity) AS value FROM lineitem GROUP BY ALL",
    "monthly": "SELECT cell, year, month, sum(value) AS value FROM cells GROUP BY ALL",
    "zones": "SELECT s_suppkey AS cell, s_name AS admin2, n_name AS admin1, r_name AS admin0, n_nationkey AS admin1_code, r_regionkey AS admin0_code FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "calendar": "SELECT DISTINCT cell, CAST(1 + cell % 12 AS INT) AS plant, CAST(2 + cell % 3 AS INT) AS span FROM cells",
    "pos": "SELECT m.cell, m.value, m.year, m.month, span, CAST(floor((12 * m.year + m.month - plant) / 12.0) AS INT) AS season_year, (12 * m.year + m.month - plant) % 12 AS pos FROM monthly m JOIN calendar c ON m.cell = c.cell",
    "season": "SELECT cell, season_year, sum(value) AS value, count(value) AS n_months FROM pos WHERE pos <= span AND season_year >= (SELECT min(year) FROM monthly) AND season_year < (SELECT max(year) FROM monthly) GROUP BY ALL",
    "yearly": "SELECT cell, year, hazard, sum(value) AS value FROM cells GROUP BY ALL",
    "flags": "SELECT cell, year, CASE hazard WHEN 'A' THEN 'dry' WHEN 'N' THEN 'heat' ELSE 'wet' END AS hazard, CASE WHEN hazard = 'A' THEN CAST(value < 700 AS INT) ELSE CAST(value > 700 AS INT) END AS flag FROM yearly",
    "codes": "SELECT cell, year, CAST(max(flag) FILTER (hazard = 'dry') + 10 * max(flag) FILTER (hazard = 'heat') + 100 * max(flag) FILTER (hazard = 'wet') AS INT) AS code FROM flags GROUP BY ALL",
    "exposure": "SELECT l_suppkey AS cell, p_brand AS crop, sum(l_extendedprice) AS value FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL",
    "natyear": "SELECT n_name AS admin1, r_name AS admin0, CAST(year(o_orderdate) AS INT) AS year, round(sum(o_totalprice), 2) AS value FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL",
    "freq": "SELECT cell, avg(flag) AS p FROM flags WHERE hazard = 'heat' GROUP BY cell",
}
ORDER = list(CTES)
NEEDS = {"monthly": ("cells",), "calendar": ("cells",), "pos": ("monthly", "calendar"), "season": ("pos",), "yearly": ("cells",), "flags": ("yearly",), "codes": ("flags",), "freq": ("flags",)}


def _closure(names: tuple[str, ...]) -> list[str]:
    out: set[str] = set()
    todo = list(names)
    while todo:
        n = todo.pop()
        if n not in out:
            out.add(n)
            todo += NEEDS.get(n, ())
    return [n for n in ORDER if n in out]


def query(name: str, body: str | None = None, *ctes: str):
    """Register a query; body is its SQL, on the named subqueries."""

    def put(f):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if body is not None:
            SQL[name] = ("WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in _closure(ctes)) + " " if ctes else "") + body
        return f

    return put
