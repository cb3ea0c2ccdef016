"""Connected components of a table of links, in shuffles of links only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeops.session import scratch_dir


def forest(pairs: Iterator[tuple[int, int]]) -> dict[int, int]:
    """Each node's least reachable node, by union-find."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a partition as links to least nodes: as many as nodes, however many links."""
    found = forest(p for b in batches for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
    rows = [(x, r) for x, r in found.items() if x != r]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], names=["u", "v"])


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node of a component of two or more.

    `links` has two long columns without nulls. Rounds of large and small stars: every node links its
    larger neighbours, then its smaller ones, to the least it knows, until each component is one
    star. Each round is written to the shared folder. Nodes with very many links cost no more than
    their links: least neighbours are aggregated before the shuffle and joined back, where adaptive
    execution splits them.
    """
    spark = links.sparkSession
    a, b = links.columns
    current = links.where(f"`{a}` <> `{b}`").mapInArrow(_contract, "u bigint, v bigint")
    while True:
        path = scratch_dir(spark, "stars")
        current.write.parquet(path)
        stars = spark.read.parquet(path)
        # Finished when every node has one link and no link ends at a node that has one itself.
        ends = (stars.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down"))
                .unionAll(stars.select("v", F.lit(0), F.lit(1)))
                .groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")))
        if ends.where("up > 1 OR (up = 1 AND down = 1)").isEmpty():
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
                stars.select("v", "v").distinct())
        current = _small_star(_large_star(stars))


def _large_star(stars: DataFrame) -> DataFrame:
    both = stars.unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(stars: DataFrame) -> DataFrame:
    least = stars.groupBy("u").agg(F.min("v").alias("m"))
    joined = stars.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", "m")).where("u <> v").distinct()
