"""Named queries and the SQL each one is checked against."""

from __future__ import annotations

import functools
import importlib
import importlib.util
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rallyframe.plans.check_views import CHECK_VIEWS
from rallyframe.shipping import ship

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_CHECKS: dict[str, str] = {}
_CATALOG = ("functions", "sources", "imports", "identity", "merging", "ratings", "backtests",
            "picks", "ledgers", "profiles", "streams")


def _shipped(fn: Query) -> Query:
    """Workers get the package before a query runs."""
    @functools.wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf)
    return run


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        _QUERIES[name] = _shipped(fn)
        if check is not None:
            _CHECKS[name] = check
        return fn
    return register


def _needed_views(sql: str, found: dict[str, None]) -> None:
    for name in dict.fromkeys(re.findall(r"\b\w+_v\b", sql)):
        if name in CHECK_VIEWS and name not in found:
            body = re.sub(rf"\b{name}\b", "", CHECK_VIEWS[name])  # a recursive view names itself
            _needed_views(body, found)
            found[name] = None


def with_views(sql: str) -> str:
    """Prefix a check query with the derived views it mentions, in order."""
    found: dict[str, None] = {}
    _needed_views(sql, found)
    parts = [v if v.lstrip().startswith(n) else f"{n} AS ({v})"
             for n, v in ((n, CHECK_VIEWS[n].strip()) for n in found)]
    body = sql.strip()
    if body.upper().startswith("WITH "):
        parts.append(re.sub(r"(?is)^with\s+(recursive\s+)?", "", body, count=1))
        return "WITH RECURSIVE " + ",\n".join(parts)
    if not parts:
        return body
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + body


def load() -> None:
    for module in _CATALOG:
        name = f"rallyframe.plans.catalog.{module}"
        if importlib.util.find_spec(name):
            importlib.import_module(name)


def all_queries() -> dict[str, Query]:
    load()
    return dict(_QUERIES)


def all_checks() -> dict[str, str]:
    load()
    return {name: with_views(sql) for name, sql in _CHECKS.items()}
