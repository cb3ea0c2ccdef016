"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source has a target in words. It is met by complete epochs of the source, then by a fraction of
one more: documents get exponential keys, scaled by their quality weight, and are taken in the order
of the keys while their sizes fill what is left. The order is that of a weighted sample without
replacement, and the same on every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeops.llm.quality_rules import SPACES, SYMBOLS, words_of
from lakeops.llm.registry import query, table
from lakeops.operators.skew import range_slices
from lakeops.session import scratch_dir

SLICE_ROWS = 100_000
MAX_BROADCAST_SOURCES = 100_000  # about 100 bytes each


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, cap: float) -> DataFrame:
    """source, source_size, target: `share` of all sizes, split by weight, up to `cap` of each source.

    The sources in code point order, null last, get the weights in turn. What a source can't take is
    reshared by weight: with sources in order of cap to weight, those are capped whose cap is at most
    their part of what the ones before leave. One row per source.
    """
    place = F.expr("row_number() OVER (ORDER BY source ASC NULLS LAST) - 1")
    weight = F.get(F.array(*map(F.lit, weights)), (place % len(weights)).cast("int"))
    ranked = (sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(cap)))
              .withColumn("total", F.expr("sum(source_size) OVER ()") * F.lit(float(share))))
    order = "(ORDER BY most / weight, source ASC NULLS LAST ROWS BETWEEN"
    level = ranked.withColumn("level", F.expr(
        f"(total - coalesce(sum(most) OVER {order} UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / "
        f"sum(weight) OVER {order} CURRENT ROW AND UNBOUNDED FOLLOWING)"))
    # The first source in this order that isn't capped has the level of all that aren't (ties included).
    level = level.withColumn("place", F.expr("row_number() OVER (ORDER BY most / weight, source ASC NULLS LAST)"))
    free = level.withColumn("free", F.expr(
        "min(CASE WHEN level < most / weight THEN struct(place, most / weight AS m, level) END) OVER ()"))
    capped = F.col("free").isNull() | (F.col("most") / F.col("weight") < F.col("free.m"))
    return free.select("source", "source_size", F.when(capped, F.col("most")).otherwise(
        F.col("free.level") * F.col("weight")).alias("target"))


def sample_key(id_col: Column, quality: Column, seed: int) -> Column:
    """-ln(u) / quality, with u from a hash of seed and id: the less, the sooner it is taken."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null"))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / quality


def sized(docs: DataFrame, quality: Column, seed: int, id_col: str, source_col: str, text_col: str, *more: Column) -> DataFrame:
    """id, source, size (words; null has none) and sample key of each row, without the text; and `more` columns."""
    key = F.col(f"`{id_col}`").cast("bigint")
    return docs.select(key.alias("id"), F.col(f"`{source_col}`").alias("source"),
                       F.size(words_of(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))).cast("bigint").alias("size"),
                       sample_key(key, quality, seed).alias("key"), *more)


def mix_plan(rows: DataFrame, weights: Sequence[int], share: float, cap: float, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per source: source, source_size, target, epochs, and `last`, the last one taken of a further epoch.

    `rows` is a written table of `sized` rows. Prefix sums of a source's sizes run over slices of
    (source, key), so that a hot source fills many tasks: sums of slices first, then rows in their slice.
    """
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = (targets.withColumn("epochs", whole.cast("bigint"))
               .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    cut = range_slices(rows, ["source", "key", "id", "size"], max(1, -(-rows.count() // slice_rows)))
    sums = cut.groupBy("source", "_slice").agg(F.sum("size").alias("n"))
    before = sums.withColumn("before", F.expr(
        "coalesce(sum(n) OVER (PARTITION BY source ORDER BY _slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"))
    # Per slice: what is left of its source's budget. One row per source and slice that begins within it.
    budget = (before.alias("b").join(targets.alias("t"), F.expr("b.source <=> t.source"))
              .select("b.source", "b._slice", (F.col("rest") - F.col("before")).alias("left")))
    inside = (cut.alias("c").join(budget.alias("b"), F.expr("c.source <=> b.source AND c._slice = b._slice"))
              .where("left > 0").select("c.*", "left"))
    run = inside.withColumn("run", F.expr(
        "coalesce(sum(size) OVER (PARTITION BY source, _slice ORDER BY _pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"))
    # Taken while that brings the sum nearer to the budget.
    last = (run.where("2 * run + size <= 2 * left").groupBy("source")
            .agg(F.max(F.struct("key", F.coalesce("id", F.lit(-1 << 63)).alias("id"), "size")).alias("last")))
    return (targets.alias("t").join(last.alias("l"), F.expr("t.source <=> l.source"), "left")
            .select("t.source", "source_size", "target", "epochs", "last"))


def mix(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows with `source_size`, `target` and `times`, how often the mix takes each.

    The plan is written first, and sent to every task if it has few enough sources.
    """
    path = scratch_dir(rows.sparkSession, "plan")
    plan.write.parquet(path)
    plan = rows.sparkSession.read.parquet(path)
    if plan.count() <= MAX_BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    mine = F.expr("struct(key, coalesce(id, -9223372036854775808L) AS id, size)")
    more = F.coalesce(mine <= F.col("last"), F.lit(False)).cast("bigint")
    return (rows.alias("r").join(plan.alias("p"), F.expr("r.source <=> p.source"))
            .select("r.*", "source_size", "target", (F.col("epochs") + more).alias("times")))


# The query's parameters.
WEIGHTS, SHARE, CAP, SEED = (5, 2, 1), 1.5, 2.0, 7


def cleanness(text_col: str = "text") -> Column:
    """A quality weight in (0, 1]: the share of characters that are no symbols."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return (F.length(text) + 1.0 - symbols) / (F.length(text) + 1.0)


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
          quality: Column | None = None, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: float = CAP,
          seed: int = SEED) -> DataFrame:
    """One row per row of `docs`: id, source, size, source_size, target and `times` that the mix takes it.

    A null text has no words; a null source is a source of its own. A source's taken words differ from
    its target by at most half of the document where the sum crosses it. Rows alike in id, source and
    size (repeats) are taken together. An empty table gives no rows; other columns aren't read.
    """
    spark, path = docs.sparkSession, scratch_dir(docs.sparkSession, "sizes")
    sized(docs, cleanness(text_col) if quality is None else quality, seed, id_col, source_col, text_col).write.parquet(path)
    rows = spark.read.parquet(path)
    return mix(rows, mix_plan(rows, weights, share, cap)).select("id", "source", "size", "source_size", "target", "times")


def mixture(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
            quality: Column | None = None, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: float = CAP,
            seed: int = SEED) -> DataFrame:
    """The mix itself: each row of `docs` with all its columns as often as it is taken (see `mixed`).

    Only the plan, one row per source, meets the texts.
    """
    spark, path = docs.sparkSession, scratch_dir(docs.sparkSession, "sizes")
    quality = cleanness(text_col) if quality is None else quality
    sized(docs, quality, seed, id_col, source_col, text_col).write.parquet(path)
    plan = mix_plan(spark.read.parquet(path), weights, share, cap)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    taken = mix(sized(docs, quality, seed, id_col, source_col, text_col, row), plan).where("times > 0")
    return taken.select(F.explode(F.array_repeat("row", F.col("times").cast("int"))).alias("row")).select("row.*")


SQL = r"""
WITH n AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
         ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT AS h FROM documents),
k AS (
  SELECT doc_id, source, size,
         -ln((h + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / ((length(text) + 1.0::DOUBLE - (length(text) - length(translate(text, '#*$%&|<>', ''))))
          / (length(text) + 1.0::DOUBLE)) AS key FROM n),
s AS (SELECT source, sum(size)::DOUBLE AS source_size FROM k GROUP BY source),
w AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
         2.0::DOUBLE * source_size AS most, 1.5::DOUBLE * sum(source_size) OVER () AS total FROM s),
l AS (
  SELECT *, (total - coalesce(sum(most) OVER (ORDER BY most / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY most / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
         row_number() OVER (ORDER BY most / weight, source ASC NULLS LAST) AS place FROM w),
f AS (SELECT min(most / weight) AS m, min_by(level, place) AS free FROM l WHERE level < most / weight),
t AS (
  SELECT source, source_size, CASE WHEN m IS NULL OR most / weight < m THEN most ELSE free * weight END AS target FROM l LEFT JOIN f ON true),
r AS (
  SELECT k.doc_id, k.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, round(target, 4) AS target,
       (size * (epochs + CASE WHEN 2 * run + size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken FROM r
"""


@query("op7_mixing", SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", F.round("target", 4).alias("target"),
        (F.col("size") * F.col("times")).alias("taken"))
