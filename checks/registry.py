"""The list of checked queries: a Spark plan and, where SQL can say it, the SQL for comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from checks.views import Views, views as views_of
from checks.views_sql import with_views

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = ""):
    """Register a function of Views under a name, with its SQL over the named views."""
    def register(build: Callable[[Views], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(views_of(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = with_views(views.split(), sql)
        return build

    return register


def load() -> None:
    """Import every module that registers queries."""
    from checks import (  # noqa: F401
        q_columns, q_filters, q_index, q_joins, q_prices, q_profile, q_ranking, q_regions,
        q_sources, q_targets,
    )
