"""Where the operators' queries and their SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register `build(spark, sf_dir) -> DataFrame` as query `name`, checked by `sql` where there is one."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


# Rows that go to a Python worker at once: whole texts, so a few megabytes.
ARROW_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table by name; batches to Python workers are small, unless the session's owner has set their size."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not spark.sparkContext.getConf().contains(rows):
        spark.conf.set(rows, ARROW_ROWS)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
