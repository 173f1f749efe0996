"""The register that the query modules fill: queries by name and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitrine.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a function of a table loader under its own name, with its SQL where there is one."""

    def register(plan: Callable[[Callable[[str], DataFrame]], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plan(lambda name: table(spark, sf_dir, name))

        run.__doc__ = plan.__doc__
        QUERIES[plan.__name__] = run
        if oracle:
            ORACLE_SQL[plan.__name__] = oracle
        return plan

    return register
