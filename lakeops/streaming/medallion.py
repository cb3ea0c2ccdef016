"""Bronze, silver and gold: raw append, cleaned and validated stream, recomputed aggregates."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType, TimestampType

from lakeops.operators.rules import Expectations, expect
from lakeops.streaming.io import BATCH_BYTES, finish, ingest_new_files, read_stream, write_stream

SILVER_METRICS = "silver_expectations"


def bronze(spark: SparkSession, src: str, dst: str, checkpoint: str, schema: StructType,
           fmt: str = "parquet", max_bytes: int | None = BATCH_BYTES) -> StreamingQuery:
    """Append new raw files, as they are, with the time of ingestion."""
    return ingest_new_files(spark, src, dst, checkpoint, schema, fmt, max_bytes=max_bytes,
                            add=lambda df: df.withColumn("ingestion_timestamp", F.current_timestamp()))


def renamed(df: DataFrame, columns: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """The columns under new names, cast where a type is given: `{new: (old, type)}`; absent ones are left out."""
    return df.select(*[(F.col(old).cast(kind) if kind else F.col(old)).alias(new)
                       for new, (old, kind) in columns.items() if old in df.columns])


def silver(bronze_rows: DataFrame, rules: Expectations, clean: Callable[[DataFrame], DataFrame],
           metrics: str | None = SILVER_METRICS) -> DataFrame:
    """Expectations, then cleaning; failures are counted on the way, in the same pass."""
    return clean(expect(bronze_rows, rules, metrics)).withColumn("processing_timestamp", F.current_timestamp())


@dataclass(frozen=True)
class Medallion:
    """Where the layers of one flow are kept."""

    root: str

    def path(self, layer: str) -> str:
        return f"{self.root}/{layer}"

    def checkpoint(self, layer: str) -> str:
        return f"{self.root}/checkpoints/{layer}"


def run_medallion(spark: SparkSession, src: str, root: str, schema: StructType, rules: Expectations,
                  clean: Callable[[DataFrame], DataFrame], gold: Mapping[str, Callable[[DataFrame], DataFrame]],
                  fmt: str = "parquet", max_bytes: int | None = BATCH_BYTES) -> tuple[dict[str, DataFrame], StreamingQuery]:
    """Bring all layers up to date with the files in `src`; a second run handles only new files.

    `clean` makes silver rows of bronze ones, `gold` names the reports over silver. A micro-batch
    takes about `max_bytes`. Every run writes its gold reports to a new folder, so that readers of
    the last ones are not disturbed. Returns the reports, as written, and the finished silver query
    (its progress holds the expectation counts).
    """
    flow = Medallion(root)
    bronze(spark, src, flow.path("bronze"), flow.checkpoint("bronze"), schema, fmt, max_bytes)
    bronze_schema = StructType([*schema.fields, StructField("ingestion_timestamp", TimestampType())])
    raw = read_stream(spark, flow.path("bronze"), bronze_schema, fmt="parquet", max_bytes=max_bytes)
    query = finish(write_stream(silver(raw, rules, clean), flow.path("silver"), flow.checkpoint("silver")))
    rows, run = spark.read.parquet(flow.path("silver")), uuid.uuid4().hex[:12]
    out = {}
    for name, build in gold.items():
        path = f"{flow.path(name)}/{run}"
        build(rows).write.parquet(path)
        out[name] = spark.read.parquet(path)
    return out, query
