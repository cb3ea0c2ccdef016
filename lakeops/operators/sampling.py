"""Sampling operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lakeops.functions import random_int

# A prime, and a multiplier near its golden section, which spreads neighbouring keys.
_SPREAD, _PRIME = 618_034, 1_000_003


def sample_rows(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Random sample; repeatable for a seed as long as the file layout stays."""
    return df.sample(fraction=fraction, seed=seed)


def sample_hash(df: DataFrame, key: str, per_mille: int) -> DataFrame:
    """Sample of the keys, the same on any layout or engine: by the remainder of a spread integer."""
    spread = F.pmod(F.col(key) % _PRIME * _SPREAD, F.lit(_PRIME))
    return df.where(spread * 1000 < F.lit(per_mille * _PRIME))


def with_random_int(df: DataFrame, name: str, low: int, high: int, seed: int | None = None) -> DataFrame:
    """Add a random integer column, `low..high`."""
    return df.withColumn(name, random_int(low, high, seed))


def split_into_batches(df: DataFrame, n: int, key: Sequence[str], path: str, fmt: str = "json") -> None:
    """Write disjoint batch folders `batch_id=0..n-1`, by key hash, in one distributed write."""
    (df.withColumn("batch_id", F.pmod(F.xxhash64(*key), F.lit(n)).cast("int"))
     .write.mode("overwrite").partitionBy("batch_id").format(fmt).save(path))
