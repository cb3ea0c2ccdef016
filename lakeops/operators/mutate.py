"""Row-level changes as DataFrame transformations: update, delete, merge, latest row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from lakeops.functions import struct_of
from lakeops.operators.skew import BROADCAST_BYTES, broadcast_if_small
from lakeops.session import scratch_dir


def _expr(value: Column | str) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def update_where(df: DataFrame, set: Mapping[str, Column | str],
                 where: Column | str | None = None) -> DataFrame:
    """Set columns where the condition is true; every expression sees the old values.

    Values are cast to the type of the column they replace. New column names are added, NULL on
    rows the condition leaves out.
    """
    condition = None if where is None else _expr(where)

    def new(column: str) -> Column:
        value = _expr(set[column])
        if column in df.columns:
            value = value.cast(df.schema[column].dataType)
        if condition is None:
            return value
        old = F.col(f"`{column}`") if column in df.columns else F.lit(None)
        return F.when(condition, value).otherwise(old)

    names = [*df.columns, *[c for c in set if c not in df.columns]]
    return df.select(*[(new(c) if c in set else F.col(f"`{c}`")).alias(c) for c in names])


def delete_where(df: DataFrame, where: Column | str) -> DataFrame:
    """Drop rows where the condition is true; a NULL condition keeps the row."""
    return df.where(~F.coalesce(_expr(where), F.lit(False)))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of greatest `order` of each key.

    An aggregate, not a window: tasks reduce their rows before the shuffle, so a hot key sends one
    row per task. Make `order` unique within a key for a definite result.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(struct_of(rest), struct_of(order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def kept_still(df: DataFrame) -> DataFrame:
    """The rows written to the shared scratch folder: read several times, they are computed once and stay the same."""
    if getattr(df, "_kept_still", False):
        return df
    path = scratch_dir(df.sparkSession, "still")
    untyped = {f.name: F.col(f"`{f.name}`").cast("string") for f in df.schema.fields if f.dataType.typeName() == "void"}
    df.withColumns(untyped).write.parquet(path)
    out = df.sparkSession.read.parquet(path)
    out._kept_still = True
    return out


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str],
          set: Mapping[str, Column | str] | None = None, insert: bool = True,
          delete_when: Column | str | None = None,
          broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Upsert `source` into `target` on equal keys; NULL keys never match.

    Matched rows: dropped where `delete_when` is true, else the columns in `set` change. The
    expressions name target columns plainly and source columns as `source.<name>`; the default sets
    all columns from the source. Source rows without a match are inserted, absent columns as NULL.
    Several source rows for one matched key raise, when the result is computed.

    A source whose keys, with a row of each, take at most `broadcast_bytes` (they are measured first)
    is broadcast, and the target not shuffled: its rows stream by once for the updates, its keys once
    more for the inserts. A larger one meets the target in one full outer join: both are read and
    shuffled once. The rows of a key are never gathered: an aggregate keeps their count and one of
    them, and rows of unmatched keys with several, or with a NULL key, are inserted from the source
    itself; a larger source's keys are counted first, and only if there are such is it read again. The source is computed
    once: what is measured, joined and inserted are the same rows.
    """
    source = kept_still(source)
    others = [c for c in target.columns if c not in keys]
    if set is None:
        set = {c: f"source.`{c}`" for c in others if c in source.columns}
    one = source.groupBy(*[F.col(f"`{k}`").alias(f"_k_{k}") for k in keys]).agg(
        F.count(F.lit(1)).alias("_n"), F.first(struct_of(source.columns)).alias("_source"))
    measured = broadcast_if_small(one, broadcast_bytes)
    small = measured is not one
    same = reduce(lambda a, b: a & b, [F.col(f"`{k}`") == F.col(f"`_k_{k}`") for k in keys])
    marked = target.withColumn("_met", F.lit(True))
    joined = marked.join(measured, same, "left" if small or not insert else "full_outer")

    hit = F.col("_met").isNotNull() & F.col("_n").isNotNull()
    ambiguous = F.raise_error(F.lit("merge: several source rows match one target row"))
    source_row = F.when(hit & (F.col("_n") > 1), ambiguous.cast(source_type(source))).otherwise(F.col("_source"))
    joined = joined.withColumn("source", source_row)
    if delete_when is not None:
        joined = joined.where(~(hit & F.coalesce(_expr(delete_when), F.lit(False))))
    updated = struct_of_columns({
        c: F.when(hit, _expr(set[c]).cast(target.schema[c].dataType)).otherwise(F.col(f"`{c}`")) if c in set else F.col(f"`{c}`")
        for c in target.columns})

    def new(row: Column) -> Column:
        return struct_of_columns({c: (row[c] if c in source.columns else F.lit(None)).cast(target.schema[c].dataType)
                                  for c in target.columns})

    def inserted(rows: DataFrame) -> DataFrame:
        return rows.select(new(struct_of(source.columns)).alias("_row")).select("_row.*")

    if not insert:
        return joined.select(updated.alias("_row")).select("_row.*")
    key_columns = [F.col(f"`_k_{k}`").alias(k) for k in keys]
    if small:
        met = target.select(*keys).join(F.broadcast(one.select(*key_columns)), list(keys), "left_semi").distinct()
        return joined.select(updated.alias("_row")).select("_row.*").unionByName(
            inserted(source.join(F.broadcast(met), list(keys), "left_anti")))

    def some_null(names: Sequence[str]) -> Column:
        return reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in names])

    no_key = some_null([f"_k_{k}" for k in keys])
    alone = (F.col("_n") == 1) & ~no_key
    row = F.when(F.col("_met").isNotNull(), updated).otherwise(new(F.col("_source")))
    merged = joined.where(F.col("_met").isNotNull() | alone).select(row.alias("_row")).select("_row.*")
    if one.where(~alone).isEmpty():
        return merged
    several = one.where((F.col("_n") > 1) & ~no_key).select(*key_columns)
    several_measured = broadcast_if_small(several, broadcast_bytes)
    met = target.select(*keys).join(several_measured, list(keys), "left_semi").distinct()
    unmet = several.join(met, list(keys), "left_anti")
    if several_measured is not several:
        unmet = F.broadcast(unmet)
    return (merged.unionByName(inserted(source.join(unmet, list(keys), "left_semi")))
            .unionByName(inserted(source.where(some_null(keys)))))


def source_type(df: DataFrame) -> StructType:
    """A frame's row as a type whose fields may all be NULL."""
    return StructType([StructField(f.name, f.dataType) for f in df.schema.fields])


def struct_of_columns(columns: Mapping[str, Column]) -> Column:
    return F.struct(*[value.alias(name) for name, value in columns.items()])


def pair_up(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with the `_before` and `_after` rows as structs (NULL where absent).

    Keys compare null-safe. Both sides meet in one aggregate, so either may repeat rows without the
    join of a hot key blowing up; a key that is not unique on a side raises.
    """
    columns = before.columns
    if sorted(columns) != sorted(after.columns):
        raise ValueError(f"the two sides differ in columns: {sorted({*columns} ^ {*after.columns})}")
    both = (before.select(*keys, F.lit(0).alias("_side"), struct_of(columns).alias("_row"))
            .unionByName(after.select(*keys, F.lit(1).alias("_side"), struct_of(columns).alias("_row"))))
    paired = both.groupBy(*keys).agg(
        F.first(F.when(F.col("_side") == 0, F.col("_row")), ignorenulls=True).alias("_before"),
        F.first(F.when(F.col("_side") == 1, F.col("_row")), ignorenulls=True).alias("_after"),
        F.count_if(F.col("_side") == 0).alias("_n0"),
        F.count_if(F.col("_side") == 1).alias("_n1"))
    twice = F.raise_error(F.lit(f"key {list(keys)} is not unique"))
    unique = F.when((F.col("_n0") > 1) | (F.col("_n1") > 1), twice.cast("boolean")).otherwise(F.lit(True))
    return paired.where(unique).drop("_n0", "_n1")


def differences(paired: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys whose `_before` and `_after` images differ, how, and in which of the columns."""
    before, after = F.col("_before"), F.col("_after")
    change = F.when(before.isNull(), "added").when(after.isNull(), "removed").otherwise("changed")
    differ = F.array_compact(F.array(*[
        F.when(~F.col(f"_before.`{c}`").eqNullSafe(F.col(f"_after.`{c}`")), F.lit(c))
        for c in columns if c not in keys]))
    return paired.where(~before.eqNullSafe(after)).select(
        *[F.coalesce(F.col(f"_before.`{k}`"), F.col(f"_after.`{k}`")).alias(k) for k in keys],
        change.alias("change"),
        F.when(before.isNotNull() & after.isNotNull(), differ).alias("columns"))


def diff(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What differs between two snapshots: keys, `change` (added, removed, changed), changed `columns`."""
    return differences(pair_up(before, after, keys), keys, before.columns)


def change_counts(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows before and after, and how many were inserted, updated and deleted."""
    b, a = F.col("_before"), F.col("_after")
    return pair_up(before, after, keys).agg(
        F.count(b).alias("before_count"),
        F.count(a).alias("after_count"),
        F.count_if(b.isNull()).alias("inserted"),
        F.count_if(b.isNotNull() & a.isNotNull() & ~b.eqNullSafe(a)).alias("updated"),
        F.count_if(a.isNull()).alias("deleted"))
