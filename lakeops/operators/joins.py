"""Time-interval and integrity joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def orphans(child: DataFrame, parent: DataFrame, on: dict[str, str]) -> DataFrame:
    """Child rows whose (non-NULL) key has no parent; `on` maps child columns to parent columns.

    Copies of a parent key are combined before the shuffle, so a hot one is a row per task.
    """
    keys = parent.select(*[F.col(p).alias(f"_p_{c}") for c, p in on.items()]).distinct()
    match = [F.col(c) == F.col(f"_p_{c}") for c in on]
    return child.dropna(subset=list(on)).join(keys, match, "left_anti")


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str,
                  before: int, after: int, splits: int = 1) -> DataFrame:
    """Pairs of equal `keys` where the right time lies within `before`/`after` seconds of the left.

    Columns other than the keys must differ between the sides, but for `ts`, which comes back as
    `ts` (left) and `ts_right`. Works on static and streaming frames (give those a watermark).

    Time buckets as wide as the interval join the equality: a row can only meet rows of its own or
    the next bucket, so a hot key is cut along time and its rows are never all paired. `splits`
    cuts the left rows of a bucket further, and copies the right rows to each part: for keys that
    are hot within one interval. Every pair is found in exactly one (bucket, part).
    """
    width = before + after + 1
    bucket = F.floor(F.unix_timestamp(ts) / width)
    left_part = F.pmod(F.xxhash64(*left.columns), F.lit(splits)).cast("int")
    probe = left.withColumn("_bucket", bucket).withColumn("_part", left_part)
    first = F.floor((F.unix_timestamp(ts) - after) / width)
    last = F.floor((F.unix_timestamp(ts) + before + 1) / width)
    parts = F.array(*[F.lit(i) for i in range(splits)])
    build = (right.withColumn("_bucket", F.explode(F.sequence(first, last)))
             .withColumn("_part", F.explode(parts))
             .withColumnRenamed(ts, f"{ts}_right"))
    for k in [*keys, "_bucket", "_part"]:
        build = build.withColumnRenamed(k, f"_r_{k}")
    near = [F.col(k) == F.col(f"_r_{k}") for k in [*keys, "_bucket", "_part"]]
    near += [F.col(f"{ts}_right") >= F.col(ts) - F.expr(f"INTERVAL {before} SECONDS"),
             F.col(f"{ts}_right") <= F.col(ts) + F.expr(f"INTERVAL {after} SECONDS")]
    condition = near[0]
    for c in near[1:]:
        condition = condition & c
    pairs = probe.join(build, condition, "inner")
    return pairs.drop("_bucket", "_part", *[f"_r_{k}" for k in [*keys, "_bucket", "_part"]])
