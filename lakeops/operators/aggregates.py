"""Grouped statistics, top-k reports and table summaries.

All aggregates here combine on the map side, so a hot key costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def count_by(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The `k` rows of largest `by`; `ties` makes the choice among equals definite.

    Planned as TakeOrderedAndProject: each task keeps k rows, no global sort.
    """
    return df.orderBy(F.desc(by), *[F.asc(t) for t in ties]).limit(k)


def order_totals(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lines to orders: value and number of products of each order."""
    return lines.groupBy(*keys).agg(F.sum("line_total").alias("order_total"),
                                    F.count(F.lit(1)).alias("num_products"))


def report(df: DataFrame, keys: Sequence[str], stats: Mapping[str, Column | str]) -> DataFrame:
    """One row per key with the named statistics (aggregates, or their SQL); without keys, one row in all."""
    return df.groupBy(*keys).agg(*[(F.expr(s) if isinstance(s, str) else s).alias(name) for name, s in stats.items()])


def nested_sizes(records: DataFrame, keys: Sequence[str], items: str, name: str) -> DataFrame:
    """Items of each key in all, over however many records the key has."""
    size = F.coalesce(F.size(items), F.lit(0)).cast("bigint")
    return records.groupBy(*keys).agg(F.sum(size).alias(name))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Rows without their copies."""
    return df.distinct()


def column_summary(df: DataFrame, columns: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of numeric columns: one row per column.

    One pass: every statistic is an aggregate of a single job. Quartiles are approximate.
    """
    stats = [("count", F.count), ("mean", F.avg), ("stddev", F.stddev), ("min", F.min), ("max", F.max)]
    one_pass = df.agg(*[
        F.struct(F.lit(c).alias("column"), *[f(c).cast("double").alias(n) for n, f in stats],
                 F.percentile_approx(c, [0.25, 0.5, 0.75], accuracy).cast("array<double>").alias("_q")).alias(c)
        for c in columns
    ])
    rows = one_pass.select(F.inline(F.array(*columns)))
    return rows.select("column", *[n for n, _ in stats],
                       *[F.col("_q")[i].alias(f"q{25 * (i + 1)}") for i in range(3)])


def text_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count of values, least and greatest value, as text, of columns of any ordered type."""
    stats = [("count", F.count), ("min", F.min), ("max", F.max)]
    one_pass = df.agg(*[
        F.struct(F.lit(c).alias("column"), *[(f(c) if n == "count" else f(c).cast("string")).alias(n) for n, f in stats]).alias(c)
        for c in columns])
    return one_pass.select(F.inline(F.array(*columns)))
