"""Where queries and their check SQL register under one name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from footfall.session import use_report_settings
from footfall.workload.log import oracle_ctes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, check: str | None = None):
    """Register a query; ``check`` is complete SQL for the check engine."""

    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(use_report_settings(spark), sf_dir)

        QUERIES[name] = run
        if check is not None:
            ORACLES[name] = check
        return build

    return register


def over_log(select: str, *lookups: str, ctes: str = "") -> str:
    """Check SQL over ``log``, the named lookups and further common table expressions."""
    return f"with {oracle_ctes(*lookups)}{',' + ctes if ctes else ''}\n{select}"
