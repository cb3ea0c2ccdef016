"""Merging a change stream into a table without rewriting the table per micro-batch.

A micro-batch appends one small folder: for every key it met, the first row and, if there are more,
the last row. Readers fold these over the base rows (merge on read); `compact_merged` writes the
folded state as a new base now and then. A replayed batch replaces its own folder.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeops.functions import struct_of
from lakeops.operators.cdc import scd2_splice, scd2_state
from lakeops.operators.mutate import kept_still, latest_per_key
from lakeops.operators.skew import broadcast_if_small
from lakeops.streaming.io import write_stream_batches

BASE = -1


def _folded(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First and last row (by `_seq`) per key; combines on the map side.

    `_last` is NULL where the key has one row only. Rows of one sequence are the same row, so a batch
    that comes again, even after its rows were folded into the base, changes nothing.
    """
    last = F.coalesce("_last", "_first")
    both = rows.groupBy(*keys).agg(
        F.min_by("_first", "_first._seq").alias("_first"),
        F.max_by(last, F.coalesce("_last._seq", "_first._seq")).alias("_last"))
    several = ~F.col("_last._seq").eqNullSafe(F.col("_first._seq"))
    return both.withColumn("_last", F.when(several, F.col("_last")))


def _single(rows: DataFrame, keys: Sequence[str], seq: Column) -> DataFrame:
    row = F.struct(seq.alias("_seq"), struct_of([c for c in rows.columns if c not in keys]).alias("row"))
    out = rows.select(*keys, row.alias("_first"))
    return out.withColumn("_last", F.lit(None).cast(out.schema["_first"].dataType))


def _write(folded: DataFrame, path: str, batch_id: int) -> None:
    folded.write.mode("overwrite").parquet(f"{path}/_batch_id={batch_id}")


def start_table(base: DataFrame, path: str, keys: Sequence[str], seq: Sequence[str]) -> None:
    """Write the base rows of a merge table; `base` has the columns of the stream.

    Base rows sort before all stream rows: their sequence columns are NULL inside the table.
    """
    order = F.struct(*[F.lit(None).cast(base.schema[c].dataType).alias(c) for c in seq])
    _write(_single(base, keys, order), path, BASE)


def stream_merge(stream: DataFrame, path: str, keys: Sequence[str], seq: Sequence[str],
                 checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Merge a stream into the table at `path`; `seq` orders the rows of a key."""

    def apply(rows: DataFrame, batch_id: int) -> None:
        _write(_folded(_single(rows, keys, struct_of(seq)), keys), path, batch_id)

    return write_stream_batches(stream, apply, checkpoint, trigger)


def merged_state(spark: SparkSession, path: str, keys: Sequence[str], columns: Sequence[str],
                 set: Mapping[str, str]) -> DataFrame:
    """The merged table: `columns` from the first row of a key, those in `set` from its last.

    `set` maps a column to the stream column that updates it. The first row of a key is its base
    row, or else an insert and taken as it came; the update columns count from the second row on.
    """
    folded = _folded(spark.read.parquet(path).drop("_batch_id"), keys)
    changed = F.col("_last").isNotNull()
    return folded.select(*keys, *[
        (F.when(changed, F.col(f"_last.row.{set[c]}")).otherwise(F.col(f"_first.row.{c}"))
         if c in set else F.col(f"_first.row.{c}")).alias(c)
        for c in columns if c not in keys])


def compact_merged(spark: SparkSession, path: str, dst: str, keys: Sequence[str]) -> None:
    """Fold all batches into the base of a new table at `dst`; continue the stream there."""
    _write(_folded(spark.read.parquet(path).drop("_batch_id"), keys), dst, BASE)


def _scd2_rows(spark: SparkSession, path: str, before: int | None, like: DataFrame) -> DataFrame:
    """The state rows written by the batches up to `before` (not included), each batch's in a folder of its own."""
    stored = spark.read.schema(like.withColumn("_batch_id", F.lit(0).cast("bigint")).schema).parquet(path)
    return stored if before is None else stored.where(F.col("_batch_id") < before)


def _newest(rows: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """Of each state row the version written last."""
    return latest_per_key(rows, [*keys, *seq], ["_batch_id"]).drop("_batch_id")


def stream_scd2(stream: DataFrame, path: str, keys: Sequence[str], seq: Sequence[str], columns: Sequence[str],
                delete_when: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Keep a history (`cdc.scd2_splice`) of a change stream at `path`.

    A micro-batch reads the state rows of its own keys and writes the rows it changes to its folder: later versions of a state row
    win. A repeated batch reads the folders of earlier batches only, and replaces its own. Fold them now and then with `compact_scd2`.
    """
    spark, kind = stream.sparkSession, stream.schema

    def apply(rows: DataFrame, batch_id: int) -> None:
        empty = scd2_state(spark.createDataFrame([], kind), keys, seq, columns, delete_when)
        if batch_id == 0 and not _exists(spark, path):
            stored = empty.withColumn("_batch_id", F.lit(0).cast("bigint"))
        else:
            stored = _scd2_rows(spark, path, batch_id, empty)
        wanted = broadcast_if_small(kept_still(rows.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()))
        same = reduce(lambda a, b: a & b, [stored[k].eqNullSafe(F.col(f"_k_{k}")) for k in keys])
        state = kept_still(_newest(stored.join(wanted, same, "left_semi"), keys, seq))
        changed = scd2_splice(state, rows, keys, seq, columns, delete_when)
        changed.write.mode("overwrite").parquet(f"{path}/_batch_id={batch_id}")

    return write_stream_batches(stream, apply, checkpoint, trigger)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where)


def scd2_stored(spark: SparkSession, path: str, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """The state at `path`, for `cdc.scd2_history`."""
    return _newest(spark.read.parquet(path), keys, seq)


def compact_scd2(spark: SparkSession, path: str, dst: str, keys: Sequence[str], seq: Sequence[str]) -> None:
    """Fold all batches into the first folder of a new state at `dst`; continue the stream there."""
    scd2_stored(spark, path, keys, seq).write.mode("errorifexists").parquet(f"{dst}/_batch_id={BASE}")
