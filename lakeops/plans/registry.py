"""Where query modules register a query and its oracle SQL under one name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeops.plans.bindings import Tables
from lakeops.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register `build(tables) -> DataFrame` as query `name`, checked by `sql` where there is one."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(tune(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
