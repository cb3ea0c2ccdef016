"""Schema evolution, default values, audit columns, identity columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.operators.skew import group_sizes, range_slices


SLICE_ROWS = 1_000_000


def append_merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both; columns one side lacks are NULL there."""
    return old.unionByName(new, allowMissingColumns=True)


def with_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Fill NULLs of present columns, and add absent ones, from the given expressions."""
    return df.withColumns({
        c: F.coalesce(F.col(c), e) if c in df.columns else e for c, e in defaults.items()
    })


def with_generated(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add generated columns. Where one is present already, it must hold the generated value, or NULL; else this raises."""

    def value(name: str, expr: Column) -> Column:
        if name not in df.columns:
            return expr
        expr = expr.cast(df.schema[name].dataType)
        wrong = F.raise_error(F.lit(f"{name} differs from its generated value")).cast(df.schema[name].dataType)
        return F.when(F.col(name).isNull() | F.col(name).eqNullSafe(expr), expr).otherwise(wrong)

    return df.withColumns({name: value(name, expr) for name, expr in columns.items()})


def with_audit(df: DataFrame, source: str, at: Column | None = None) -> DataFrame:
    """Add `data_source`, `last_updated` and `ingestion_date`; `at` fixes the time."""
    now = at if at is not None else F.current_timestamp()
    return df.withColumns({"data_source": F.lit(source), "last_updated": now,
                           "ingestion_date": F.to_date(now)})


def assign_identity(df: DataFrame, by: Sequence[str], name: str = "id", start: int = 1,
                    partitions: int | None = None, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Number all rows `start, start+1, ...` in the order of `by`, with no gaps.

    The rows are cut into `partitions` slices, or as many as make about `slice_rows` each.

    Rows are range-partitioned, so no task sorts the whole table: the number is the position
    within the partition plus the sizes of the partitions before it.
    """
    n = partitions or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // slice_rows))
    ranged = range_slices(df, by, n)
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice: n rows at most, hence the unpartitioned window and the broadcast.
    offsets = group_sizes(ranged, ["_slice"]).select(
        "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (ranged.join(F.broadcast(offsets), "_slice")
            .withColumn(name, F.col("_offset") + F.col("_pos") + F.lit(start).cast("bigint"))
            .drop("_slice", "_pos", "_offset"))
