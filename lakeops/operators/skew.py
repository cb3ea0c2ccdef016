"""Measuring group sizes, and cutting ordered data into slices no hot key can overfill."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType

from lakeops.session import scratch_dir


def group_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key; reads the key columns only and combines before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def group_extent(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows of the largest group and of all groups: two numbers on the driver."""
    row = group_sizes(df, keys).agg(F.max("_n").alias("largest"), F.sum("_n").alias("total")).first()
    return row["largest"] or 0, row["total"] or 0


def range_partitioned(df: DataFrame, by: Sequence[str], partitions: int) -> DataFrame:
    """Range partitions of `by`, each sorted, none overfilled by a hot value.

    Rows of equal `by` are spread by a hash of their content, so that a repeated task deals them out
    the same way; only exact copies are spread by their place in the input. (Give a frame with big
    groups of copies as a table, whose scan order is fixed.)
    """
    hashed = [f"`{f.name}`" for f in df.schema.fields if f.dataType.typeName() != "map"]
    ties = ["_content", "_place"]
    return (df.withColumn("_content", F.xxhash64(*hashed))
            .withColumn("_place", F.monotonically_increasing_id())
            .repartitionByRange(partitions, *by, *ties).sortWithinPartitions(*by).drop(*ties))


def range_slices(df: DataFrame, by: Sequence[str], slices: int) -> DataFrame:
    """The rows cut into `slices` ranges of `by` of about equal size, with `_slice` and `_pos`.

    A range partition is a slice; `_pos` numbers its rows in the order of `by` from 0. The slices
    are written to the shared scratch folder, so that they stay put when a task is repeated.
    """
    path = scratch_dir(df.sparkSession, "slices")
    (range_partitioned(df, by, slices).withColumn("_at", F.monotonically_increasing_id())
     .write.parquet(path))
    # monotonically_increasing_id: number of the partition from bit 33 up, position below.
    return (df.sparkSession.read.parquet(path)
            .withColumn("_slice", F.shiftright("_at", 33))
            .withColumn("_pos", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_at"))


# Sides of up to this many bytes may be broadcast, once they have been measured.
BROADCAST_BYTES = 32 * 1024 * 1024


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: texts and binaries as they are, nested values as JSON, others 8."""

    def size(name: str, kind: DataType) -> Column:
        if kind.typeName() in ("string", "binary", "varchar", "char"):
            return F.coalesce(F.octet_length(f"`{name}`"), F.lit(0)) + 16
        if kind.typeName() in ("array", "map", "struct"):
            return F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{name}`")))), F.lit(0)) + 16
        return F.lit(8)

    return reduce(lambda a, b: a + b, [size(f.name, f.dataType) for f in df.schema.fields], F.lit(16))


def frame_bytes(df: DataFrame) -> int:
    """About how many bytes the rows take: summed in every task, one number per task moves."""
    return df.agg(F.sum(row_bytes(df).cast("bigint")).alias("n")).first()["n"] or 0


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast if the frame measures no more than `max_bytes`.

    Spark estimates a derived frame by the files below it and would shuffle the other, huge side
    of its joins. Beyond the limit, or with `max_bytes` 0, the choice stays with Spark.
    """
    if max_bytes and frame_bytes(df) <= max_bytes:
        return F.broadcast(df)
    return df
