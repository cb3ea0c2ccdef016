"""Windowed aggregations, the same for streaming and static frames.

`delay` sets a watermark: on a stream in append mode a window comes out once the watermark has
passed its end, rows later than that are dropped, and state is bounded by keys times open windows.
Rows of a window are combined in each task before the shuffle, so a hot key costs a row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _grouped(df: DataFrame, ts: str, window: Column, keys: Sequence[str], aggs: Sequence[Column],
             delay: str | None) -> DataFrame:
    marked = df.withWatermark(ts, delay) if delay else df
    return marked.groupBy(window.alias("window"), *keys).agg(*aggs)


def tumbling(df: DataFrame, ts: str, size: str, keys: Sequence[str], aggs: Sequence[Column],
             delay: str | None = None) -> DataFrame:
    """Aggregates per key and fixed, non-overlapping time window."""
    return _grouped(df, ts, F.window(ts, size), keys, aggs, delay)


def sliding(df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str],
            aggs: Sequence[Column], delay: str | None = None) -> DataFrame:
    """Aggregates per key and overlapping window of `size`, one every `slide`."""
    return _grouped(df, ts, F.window(ts, size, slide), keys, aggs, delay)


def sessions(df: DataFrame, ts: str, gap: str, keys: Sequence[str], aggs: Sequence[Column],
             delay: str | None = None) -> DataFrame:
    """Aggregates per key and session: events at most `gap` apart belong together."""
    window = F.session_window(ts, gap)
    if df.isStreaming:
        return _grouped(df, ts, window, keys, aggs, delay)
    # A filter on a grouped session window would be pushed below the grouping and remove events
    # before they are merged, so the window of a static frame is made from aggregates.
    ends = [F.min(ts).alias("_first"), F.max(ts).alias("_last")]
    out = _grouped(df, ts, window, keys, [*ends, *aggs], delay)
    return out.withColumn("window", F.struct(
        F.col("_first").alias("start"), (F.col("_last") + F.expr(f"INTERVAL '{gap}'")).alias("end"))
    ).drop("_first", "_last")


def flatten_window(df: DataFrame) -> DataFrame:
    """Replace the window struct by `window_start` and `window_end`."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"), *rest)


def order_stats(amount: str) -> list[Column]:
    """Count, rounded average and rounded sum: the order statistics of a window."""
    return [F.count(F.lit(1)).alias("order_count"),
            F.round(F.avg(amount), 2).alias("avg_order_value"),
            F.round(F.sum(amount), 2).alias("total_revenue")]
