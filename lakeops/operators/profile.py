"""Profiling and data-quality reports. Each report is one pass over the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def null_profile(df: DataFrame) -> DataFrame:
    """NULL count and percentage of every column, in long form, computed by one aggregate."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )
    share = F.col("null_count") * F.lit(100).cast("decimal(5,0)") / F.col("_rows")
    return (counts.unpivot("_rows", df.columns, "column", "null_count")
            .select("column", "null_count",
                    F.when(F.col("_rows") > 0, F.round(share, 2)).alias("null_percentage"))
            .orderBy(F.desc("null_count"), "column"))


def duplicate_rows(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Total, distinct and surplus rows, over whole rows or the given key columns.

    Copies are combined before the shuffle, so a big group of them is one partial row per task.
    """
    groups = df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_records"),
        F.count(F.lit(1)).alias("distinct_records"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_records"),
    )


def required_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL count of each required column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "null_count")


def range_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows breaking each named rule; a rule is a condition that is true for a bad row."""
    counts = df.agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations")


def violation_examples(df: DataFrame, bad: Column, n: int = 5) -> DataFrame:
    """A few rows that break a rule, for a report."""
    return df.where(bad).limit(n)


def monitoring_view(metrics: DataFrame, name: str) -> None:
    """Name a report of one row as a view that is computed anew, with the time, whenever it is queried."""
    metrics.withColumn("metrics_timestamp", F.current_timestamp()).createOrReplaceTempView(name)


def daily_metrics(df: DataFrame, ts: str, violation: Column | None = None) -> DataFrame:
    """Rows, last update and rule violations of each day: the input of `alerts`."""
    bad = F.count_if(violation) if violation is not None else F.lit(0).cast("bigint")
    return df.groupBy(F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("record_count"), F.max(ts).alias("last_update"),
        bad.alias("violations"))


# The alert thresholds of the monitoring table.
FRESHNESS_HOURS = 24
COUNT_SHARE_OF_AVERAGE = "0.9"
GROWTH_PER_WEEK = "1.5"


def alerts(days: DataFrame) -> DataFrame:
    """Flag each day against the days before it.

    low_count: fewer rows than 90 % of the average of all earlier days; stale: more than 24 hours
    from the last update of the previous day to the last update of this one; dirty: any violation;
    growth: the rows so far exceed those a week before by more than half. `days` holds one row per
    day, so the unpartitioned window sorts a few thousand rows at most.
    """
    past = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    day_no = F.datediff("day", F.lit("1970-01-01").cast("date"))
    week_ago = Window.orderBy(day_no).rangeBetween(Window.unboundedPreceding, -7)
    hours = (F.unix_timestamp(F.col("last_update").cast("timestamp"))
             - F.unix_timestamp(F.lag("last_update").over(Window.orderBy("day")).cast("timestamp"))) / 3600
    seen = days.select(
        "day", "record_count", "violations",
        F.sum("record_count").over(past).alias("_before"),
        F.count("record_count").over(past).alias("_days"),
        hours.alias("_hours"),
        F.sum("record_count").over(so_far).alias("_size"),
        F.sum("record_count").over(week_ago).alias("_size_week_ago"),
    )
    low = F.col("record_count") * F.col("_days") < F.col("_before") * F.lit(COUNT_SHARE_OF_AVERAGE).cast("decimal(3,1)")
    grown = F.col("_size") > F.col("_size_week_ago") * F.lit(GROWTH_PER_WEEK).cast("decimal(3,1)")
    return seen.select(
        "day", "record_count",
        F.coalesce(low, F.lit(False)).alias("low_count"),
        F.coalesce(F.col("_hours") > FRESHNESS_HOURS, F.lit(False)).alias("stale"),
        (F.col("violations") > 0).alias("dirty"),
        F.coalesce(grown, F.lit(False)).alias("growth"),
    )
