"""A change log read as a stream, and applied exactly once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from lakeops.operators.cdc import apply_changes, latest_changes
from lakeops.streaming.io import write_stream_batches


def stream_changes(spark: SparkSession, path: str, schema: StructType, from_version: int | None = None,
                   max_files: int | None = None) -> DataFrame:
    """The change rows of a log (`versions.commit`) as commits arrive, from a version on.

    `schema` is that of the log's rows; the version comes from the folders. A commit that is repeated is read again: whoever applies the rows
    must go by their version, as `stream_apply` does.
    """
    fields = [f for f in schema.fields if f.name != "_commit_version"]
    reader = spark.readStream.schema(StructType([*fields, StructField("_commit_version", LongType())]))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(path)
    return rows if from_version is None else rows.where(F.col("_commit_version") >= from_version)


def stream_apply(changes: DataFrame, path: str, keys: Sequence[str], checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Keep the newest change of each key at `path`, for `applied`.

    A micro-batch writes one change per key it meets to its own folder, which a repeated batch replaces. Of several batches the version
    decides, not the order of arrival: commits that are read twice or late change nothing.
    """

    def apply(rows: DataFrame, batch_id: int) -> None:
        latest_changes(rows, keys).write.mode("overwrite").parquet(f"{path}/_batch_id={batch_id}")

    return write_stream_batches(changes, apply, checkpoint, trigger)


def applied(spark: SparkSession, target: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """The target with the changes kept at `path`."""
    return apply_changes(target, spark.read.parquet(path).drop("_batch_id"), keys)
