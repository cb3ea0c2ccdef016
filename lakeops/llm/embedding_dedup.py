"""Near duplicates among embeddings: spherical k-means cells, blocked cosine products within them.

Unit vectors with cosine of at least t lie within d = sqrt(2 - 2t). If two such vectors have
different home cells with centroids c and c', both lie within d of the plane between the cells, so
that x.c - x.c' <= d |c - c'|. A vector is therefore also sent, as a visitor, to every cell with a
lower number for which that holds: each pair meets in a cell, and no link is lost.

Beyond `MAX_CELLS` cells, each is divided by centroids of its own, and the same rule holds among its parts for all
vectors that live in or visit it; so cells grow with the rows, and dealing costs no more products than twice their root.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.llm.components import components
from lakeops.llm.registry import query, table
from lakeops.session import scratch_dir

SAMPLE = 20_000  # distinct vectors that the centroids are fitted to, at most
CELL_ROWS, MAX_CELLS = 4096, 1024
BLOCK_ROWS = 1024


def fit_centroids(sample: np.ndarray, k: int, rounds: int = 10, seed: int = 0) -> np.ndarray:
    """`k` unit centroids (fewer where vectors coincide) of unit vectors, by spherical k-means."""
    rng = np.random.default_rng(seed)
    centers = np.unique(sample[rng.permutation(len(sample))[:k]], axis=0)
    for _ in range(rounds):
        home = (sample @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, home, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(size > 0, sums / np.where(size > 0, size, 1), centers)
    return centers


def unit_rows(column: pa.Array) -> list[np.ndarray]:
    """Unit vectors in double precision; scaled by the largest component first, against overflow."""
    out = []
    for v in column.to_pylist():
        x = np.array(v, np.float64)
        x /= np.abs(x).max()
        out.append(x / math.sqrt(float(x @ x)))
    return out


def cells_of(units: np.ndarray, centers: np.ndarray, reach: float) -> list[np.ndarray]:
    """For each vector its home cell, then the lower cells that it visits."""
    scores = units @ centers.T
    home = scores.argmax(axis=1)
    apart = np.linalg.norm(centers[:, None, :] - centers[None, :, :], axis=2)
    near = scores.max(axis=1, keepdims=True) - scores <= reach * apart[home] + 1e-9
    return [np.concatenate(([h], np.flatnonzero(n[:h]))) for h, n in zip(home, near)]


@dataclass
class Cells:
    """Centroids of the cells, and of the parts of each where there are more than `MAX_CELLS` of them."""

    centers: np.ndarray
    parts: list[np.ndarray] | None = None


def dealt_to(units: np.ndarray, cells: Cells | None, reach: float) -> Iterator[tuple[int, int, bool, bool]]:
    """(row, number of the part, whether it lives in the part's cell, and in the part) for all places each vector goes to."""
    if cells is None:
        yield from ((r, 0, True, True) for r in range(len(units)))
        return
    found = cells_of(units, cells.centers, reach)
    if cells.parts is None:
        yield from ((r, int(c), v == 0, True) for r, own in enumerate(found) for v, c in enumerate(own))
        return
    most = max(len(p) for p in cells.parts)
    members: dict[int, list[tuple[int, bool]]] = {}
    for r, own in enumerate(found):
        for v, c in enumerate(own):
            members.setdefault(int(c), []).append((r, v == 0))
    for c, rows in members.items():
        for (r, home), own in zip(rows, cells_of(units[[r for r, _ in rows]], cells.parts[c], reach)):
            yield from ((r, c * most + int(p), home, v == 0) for v, p in enumerate(own))


def fit_cells(sample: np.ndarray, wanted: int) -> Cells:
    """About `wanted` cells; parts have four vectors of the sample each, at least."""
    centers = fit_centroids(sample, min(MAX_CELLS, wanted))
    if wanted <= MAX_CELLS:
        return Cells(centers)
    home, each = (sample @ centers.T).argmax(axis=1), -(-wanted // len(centers))
    parts = []
    for c in range(len(centers)):
        mine = sample[home == c]
        parts.append(fit_centroids(mine, max(1, min(each, len(mine) // 4))) if len(mine) else centers[c:c + 1])
    return Cells(centers, parts)


def linked(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of a and b have a cosine of at least `threshold`; products near it are summed exactly."""
    products = a @ b.T
    hit = products >= threshold
    for i, j in zip(*np.nonzero(np.abs(products - threshold) < 1e-12)):
        hit[i, j] = math.fsum(a[i] * b[j]) >= threshold
    return hit


MEET = ["label", "dim", "cell", "i", "j"]


def _compare(threshold: float):
    def compare(group: pa.Table) -> pa.Table:
        rep = group.column("rep").to_numpy()
        n, part = group.column("n").to_numpy(), group.column("part").to_numpy()
        home, inner = (group.column(c).to_numpy(zero_copy_only=False) for c in ("home", "inner"))
        units = np.frombuffer(b"".join(group.column("unit").to_pylist()), np.float64).reshape(len(rep), -1)
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
        # A pair counts where one of the two lives: in the cell, and in its part.
        hit = (linked(units[left], units[right], threshold) & (home[left][:, None] | home[right][None, :])
               & (inner[left][:, None] | inner[right][None, :]))
        if i == j:
            hit &= hit.T
            np.fill_diagonal(hit, False)
        links = np.zeros(len(rep), np.int64)
        links[left] += hit @ n[right]
        if i != j:
            links[right] += hit.T @ n[left]
        least = rep.copy()
        while True:  # the least of each component within the block
            before = least.copy()
            least[left] = np.minimum(least[left], np.where(hit, least[right][None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max))
            least[right] = np.minimum(least[right], np.where(hit, least[left][:, None], np.iinfo(np.int64).max).min(axis=0, initial=np.iinfo(np.int64).max))
            if np.array_equal(before, least):
                break
        some = links > 0
        return pa.table({"rep": rep[some], "links": links[some], "least": least[some]})

    return compare


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 threshold: float = 0.98, sample: int = SAMPLE, cell_rows: int = CELL_ROWS,
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per row of `vectors`: id, n_links, component_id and kept.

    Rows link if their labels are equal and their cosine, in double precision, is at least
    `threshold`. Rows with a null id, label or vector, an empty or zero vector, or components that are
    null or not finite, link with nothing; so do vectors of different lengths. Component of a row
    that links with nothing is itself; rows that repeat an id are vectors of their own. An empty table
    gives no rows; other columns aren't read.

    Equal vectors are one class, compared once. Centroids are fitted to at most `sample` distinct
    vectors; every class is dealt by them. A cell of more than `block_rows` classes is compared block
    against block in separate tasks. Links are counted in the blocks and only forests leave them.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{label_col}`").cast("string").alias("label"),
                          F.col(f"`{vector_col}`").cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = (F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & ~bad
              & F.exists("vec", lambda x: x != 0))
    keyed = rows.withColumn("ok", F.coalesce(usable, F.lit(False))).withColumns({
        "k1": F.when(F.col("ok"), F.xxhash64("vec")), "k2": F.when(F.col("ok"), F.xxhash64(F.lit(1), "vec"))})
    classes_path, dealt_path, links_path = (scratch_dir(spark, x) for x in ("vectors", "cells", "vector-links"))
    (keyed.where("ok").groupBy("label", "k1", "k2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("vec").alias("vec"))
     .withColumn("dim", F.size("vec")).write.parquet(classes_path))
    classes = spark.read.parquet(classes_path)
    centers = _fit(classes, sample, cell_rows)
    deal_schema = pa.schema([("label", pa.string()), ("dim", pa.int32()), ("cell", pa.int32()), ("rep", pa.int64()), ("n", pa.int64()),
                             ("home", pa.bool_()), ("inner", pa.bool_()), ("unit", pa.binary())])
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                labels, dims, reps, ns = (part.column(i).to_pylist() for i in range(4))
                out, units = [], unit_rows(part.column(4))
                for dim in set(dims):
                    mine = [k for k, d in enumerate(dims) if d == dim]
                    stack = np.stack([units[k] for k in mine])
                    out += [(labels[mine[r]], dim, cell, reps[mine[r]], ns[mine[r]], home, inner, units[mine[r]].tobytes())
                            for r, cell, home, inner in dealt_to(stack, centers.get(dim), reach)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), deal_schema.types)], schema=deal_schema)

    (classes.select("label", "dim", "rep", "n", "vec")
     .mapInArrow(deal, "label string, dim int, cell int, rep bigint, n bigint, home boolean, inner boolean, unit binary").write.parquet(dealt_path))
    dealt = spark.read.parquet(dealt_path)
    sizes = dealt.groupBy("label", "dim", "cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("rep", F.lit(7)), F.col("parts")).cast("int")
    placed = (dealt.join(sizes, ["label", "dim", "cell"]).withColumn("part", part)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other")))
    (placed.select(*MEET, "part", "rep", "n", "home", "inner", "unit").groupBy(*MEET)
     .applyInArrow(_compare(threshold), "rep bigint, links bigint, least bigint").write.parquet(links_path))
    links = spark.read.parquet(links_path)
    groups = components(links.select("rep", "least"))
    members = (keyed.select("id", "label", "k1", "k2")
               .join(classes.select("label", "k1", "k2", "rep", "n"), ["label", "k1", "k2"], "left")
               .join(links.groupBy("rep").agg(F.sum("links").alias("links")), "rep", "left")
               .join(groups, F.col("rep") == F.col("node"), "left"))
    component = F.coalesce("component", "rep", "id")
    return members.select(F.col("id").alias(id_col),
                          (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("n") - 1, F.lit(0))).cast("bigint").alias("n_links"),
                          component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))


def _fit(classes: DataFrame, sample: int, cell_rows: int) -> dict[int, Cells]:
    """Centroids for each vector length, from a hash sample of at most about `sample` classes."""
    n = classes.count()
    share = max(1, -(-n // sample))
    drawn: dict[int, list[np.ndarray]] = {}
    picked = classes.where(F.pmod(F.xxhash64("rep"), F.lit(share)) == 0).select("vec").limit(2 * sample).toArrow()
    for unit in unit_rows(picked.column("vec").combine_chunks()):
        drawn.setdefault(len(unit), []).append(unit)
    total = sum(map(len, drawn.values()))
    return {dim: fit_cells(np.stack(units), max(1, round(n * len(units) / total / cell_rows))) for dim, units in drawn.items()}


@query("op9_embedding_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
