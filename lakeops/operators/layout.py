"""Table layout as rewrite jobs: compaction, clustering, Z-order, and a report on the files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lakeops.operators.skew import frame_bytes, range_partitioned, range_slices
from lakeops.session import path_bytes, scratch_dir

TARGET_BYTES = 256 * 1024 * 1024

# Bytes of the rows in memory that one task reads and sorts, at most about. Files are many times smaller than their rows.
SORTED_BYTES = 256 * 1024 * 1024


def sorted_files(df: DataFrame, least: int = 1) -> int:
    """Into how many files to sort the rows: each is one task's, which holds about `SORTED_BYTES` of them however well they compress."""
    return max(least, -(-frame_bytes(df) // SORTED_BYTES))


def compact(spark: SparkSession, src: str, dst: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Rewrite many small parquet files as fewer of about `target_bytes`.

    No shuffle: the scan itself packs small files into tasks of the target size, and each task
    writes one file. The packing sizes are set on a session of its own.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    own.conf.set("spark.sql.files.minPartitionNum", str(max(1, path_bytes(spark, src) // target_bytes)))
    own.read.parquet(src).write.mode("errorifexists").parquet(dst)
    return spark.read.parquet(dst)


def _ordinal(df: DataFrame, col: str) -> Column:
    """The column as a double of the same order: for placing rows only, never for their values."""
    kind = df.schema[col].dataType.typeName()
    if kind == "date":
        return F.unix_date(col).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(col).cast("timestamp")).cast("double")
    return F.col(col).cast("double")


# Texts of a column that are drawn to find the bounds of its buckets, at most about.
SAMPLED_TEXTS = 20_000


def _text_bounds(df: DataFrame, col: str, buckets: int) -> list[str]:
    """Whole values that cut a text column into buckets of about equal size, from a bounded sample."""
    rows = df.where(F.col(col).isNotNull()).select(F.col(col).alias("t"))
    share = min(1.0, SAMPLED_TEXTS / max(1, rows.count()))
    drawn = sorted(r["t"] for r in rows.sample(share, seed=1).limit(2 * SAMPLED_TEXTS).collect())
    return sorted({drawn[len(drawn) * i // buckets] for i in range(1, buckets)}) if drawn else []


def _reached(value: Column, bounds: list, below: int) -> Column:
    """`below` and how many of the ascending bounds the value reaches: a tree of comparisons, as deep as their logarithm."""
    if not bounds:
        return F.lit(below)
    middle = len(bounds) // 2
    return F.when(value >= bounds[middle], _reached(value, bounds[middle + 1:], below + middle + 1)).otherwise(
        _reached(value, bounds[:middle], below))


def _ranked(df: DataFrame, cols: Sequence[str], bits: int) -> DataFrame:
    """Add `_z0..`: the quantile bucket of each column, 2**bits buckets; NULLs go first."""
    out, buckets = df, 1 << bits
    texts = [c for c in cols if df.schema[c].dataType.typeName() == "string"]
    others = [c for c in cols if c not in texts]
    out = out.withColumns({f"_o{cols.index(c)}": _ordinal(df, c) for c in others})
    ranks = [i / buckets for i in range(1, buckets)]
    edges = dict(zip(others, out.approxQuantile([f"_o{cols.index(c)}" for c in others], ranks, 1 / (4 * buckets)))) if others else {}
    for i, c in enumerate(cols):
        bounds = _text_bounds(df, c, buckets) if c in texts else sorted(set(edges[c]))
        value = F.col(c) if c in texts else F.col(f"_o{i}")
        if not bounds:
            out = out.withColumn(f"_z{i}", F.lit(0).cast("bigint"))
            continue
        out = out.withColumn(f"_z{i}", F.when(value.isNull(), 0).otherwise(_reached(value, bounds, 0)).cast("bigint"))
    return out.drop(*[f"_o{i}" for i in range(len(cols))])


def z_value(cols: Sequence[str], bits: int) -> Column:
    """Interleave the low `bits` of the given integer columns, first column leading."""
    n = len(cols)
    parts = [
        F.shiftleft(F.shiftright(F.col(c), b).bitwiseAND(F.lit(1).cast("bigint")), b * n + (n - 1 - i))
        for i, c in enumerate(cols) for b in range(bits)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def zorder(df: DataFrame, cols: Sequence[str], files: int, bits: int = 6) -> DataFrame:
    """Rows in Z-order of several columns, one partition per future file.

    Columns are ranked by quantiles first, so that skewed values still spread evenly over the curve.
    """
    if len(cols) * bits > 62:
        raise ValueError("too many bits for the Z-value")
    ranked = _ranked(df, cols, bits)
    names = [f"_z{i}" for i in range(len(cols))]
    keyed = ranked.withColumn("_z", z_value(names, bits)).drop(*names)
    return range_partitioned(keyed, ["_z"], files).drop("_z")


def cluster_by(df: DataFrame, cols: Sequence[str], files: int) -> DataFrame:
    """Rows clustered by one column (range order) or several (Z-order)."""
    return range_partitioned(df, cols, files) if len(cols) == 1 else zorder(df, cols, files)


def layout_report(spark: SparkSession, path: str, col: str, slices: int = 64) -> DataFrame:
    """Per file: bytes, rows, least and greatest `col`, and how many other files overlap that range.

    Files are compared by sorting the range ends of all files (two rows per file), not pairwise. The
    ends are counted in `slices` ranges, so that no task sorts them all.
    """
    stored = (spark.read.parquet(path)
              .groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
              .agg(F.count(F.lit(1)).alias("rows"), F.min(col).alias("min"), F.max(col).alias("max")))
    scratch = scratch_dir(spark, "files")
    stored.write.parquet(scratch)
    files = spark.read.parquet(scratch)
    ends = files.select("file", F.explode(F.array(
        F.struct(F.col("min").alias("at"), F.lit(0).alias("end")),
        F.struct(F.col("max").alias("at"), F.lit(1).alias("end")))).alias("e")).select("file", "e.at", "e.end")
    # At equal values the starts come first, so ranges that touch overlap.
    cut = range_slices(ends, ["at", "end"], slices)
    starts, stops = (F.sum(F.when(F.col("end") == k, 1).otherwise(0)) for k in (0, 1))
    sums = cut.groupBy("_slice").agg(starts.alias("s"), stops.alias("t"))
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # a row per slice
    before = sums.select("_slice", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("s"),
                         F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("t"))
    within = Window.partitionBy("_slice").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    seen = cut.join(F.broadcast(before), "_slice").select(
        "file", "at", "end", (F.col("s") + starts.over(within)).alias("started"),
        (F.col("t") + stops.over(within)).alias("ended"))
    # Of equal ends all count: a range that starts where mine ends has started, whichever came first.
    per_end = seen.groupBy("at", "end").agg(F.max("started").alias("started"), (F.min("ended")).alias("ended"))
    up_to = per_end.where("end = 1").select(F.col("at").alias("max"), "started")
    under = per_end.where("end = 0").select(F.col("at").alias("min"), "ended")
    # Overlapping files: those started by my end, less those ended before my start, less myself.
    return (files.join(up_to, "max", "left").join(under, "min", "left")
            .select("file", "bytes", "rows", "min", "max",
                    F.coalesce(F.col("started") - F.col("ended") - 1, F.lit(0)).alias("overlaps")))


LAYOUTS = "_layouts"


def _folder_files(df: DataFrame, folder: str) -> DataFrame:
    return df.select(F.col(folder).cast("string").alias("folder"), F.col("_metadata.file_path").alias("file"))


def overlap_depth(df: DataFrame, folder: str, col: str) -> DataFrame:
    """For each folder (a partition value) its files, bytes, and the depth of its files' ranges of `col`.

    The depth is how many files hold the same value at most, counted by stabbing: the ends of the ranges, two rows a file, in order,
    with +1 where one begins and -1 behind where one ends. 1 means that every value is in one file's range.
    """
    ranges = (df.select(F.col(folder).cast("string").alias("folder"), F.col(col).alias("value"), F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_size").alias("size"))
              .groupBy("folder", "file", "size").agg(F.min("value").alias("least"), F.max("value").alias("most")))
    some = F.col("least").isNotNull()  # a file of NULLs only has no range
    ends = ranges.select("folder", F.explode(F.array(
        F.struct(F.col("least").alias("at"), F.lit(0).alias("end"), F.when(some, 1).otherwise(0).alias("step"), F.col("size").alias("bytes")),
        F.struct(F.col("most").alias("at"), F.lit(1).alias("end"), F.when(some, -1).otherwise(0).alias("step"), F.lit(0).cast("bigint").alias("bytes"))
    )).alias("e"))
    # At equal values the begins come first: ranges that touch overlap.
    so_far = Window.partitionBy("folder").orderBy("e.at", "e.end").rowsBetween(Window.unboundedPreceding, 0)
    return ends.withColumn("n", F.sum("e.step").over(so_far)).groupBy("folder").agg(
        F.count_if(F.col("e.end") == 0).alias("files"), F.sum("e.bytes").alias("bytes"), F.max("n").alias("depth"))


def recluster(spark: SparkSession, path: str, folder: str, cols: Sequence[str], max_depth: int = 2,
              target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Cluster by `cols` the folders of a partitioned table whose files overlap in the first of them by more than `max_depth` (neighbours may share the value at their edge).

    Returns folder, files, bytes, depth and whether it was rewritten, for the folders that were looked at. What was looked at is listed
    beside the table (`_layouts`), with the names of its files: a later run, also one with other `cols`, passes over folders that
    haven't changed since, without reading them. Rows to rewrite are written aside first, then replace their folders by a dynamic partition
    overwrite, which leaves all others alone; if it breaks off, the rows are still in the scratch folder. Files get `target_bytes` at most, less
    where their rows would be more than a task should sort.
    """
    table = spark.read.parquet(path)
    listed = scratch_dir(spark, "listed")
    _folder_files(table, folder).distinct().groupBy("folder").agg(
        F.xxhash64(F.sort_array(F.collect_list("file"))).alias("state")).write.parquet(listed)
    now = spark.read.parquet(listed)
    fresh = now
    if _has(spark, f"{path}/{LAYOUTS}"):
        known = spark.read.schema("folder string, state bigint").parquet(f"{path}/{LAYOUTS}/*").withColumnsRenamed({"folder": "k", "state": "s"})
        fresh = now.join(known, F.col("folder").eqNullSafe(F.col("k")) & (F.col("state") == F.col("s")), "left_anti")
    # A row per folder on the driver, as in the table's own listing.
    names = [r["folder"] for r in fresh.select("folder").collect()]
    text = F.col(folder).cast("string")
    within = text.isin([n for n in names if n is not None]) | (text.isNull() & F.lit(None in names))
    depths = scratch_dir(spark, "depths")
    overlap_depth(table.where(F.coalesce(within, F.lit(False))), folder, cols[0]).withColumn("rewritten", F.col("depth") > max_depth).write.parquet(depths)
    report = spark.read.parquet(depths)
    chosen = report.where("rewritten").agg(F.sum("bytes").alias("bytes"), F.collect_list("folder").alias("names"),
                                           F.max(F.col("folder").isNull()).alias("none")).first()
    if chosen["bytes"]:
        rows = table.where(F.coalesce(text.isin(chosen["names"]), F.lit(False)) | (text.isNull() & F.lit(bool(chosen["none"]))))
        aside = scratch_dir(spark, "aside")
        rows.write.parquet(aside)
        still = spark.read.schema(rows.schema).parquet(aside)
        files = sorted_files(still, -(-chosen["bytes"] // target_bytes))
        _clustered_within(still, folder, cols, files).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(folder).parquet(path)
    # The files as they are now, of the folders that were looked at.
    seen = _folder_files(spark.read.parquet(path), folder).where(F.coalesce(F.col("folder").isin([n for n in names if n is not None]), F.lit(None in names)))
    (seen.distinct().groupBy("folder").agg(F.xxhash64(F.sort_array(F.collect_list("file"))).alias("state"))
     .coalesce(1).write.parquet(f"{path}/{LAYOUTS}/{scratch_dir(spark, 'run').rsplit('-', 1)[1]}"))
    return report


def _clustered_within(df: DataFrame, folder: str, cols: Sequence[str], files: int) -> DataFrame:
    """Rows by folder, and within by one column or the Z-value of several."""
    if len(cols) == 1:
        return range_partitioned(df, [folder, cols[0]], files)
    bits = min(6, 62 // len(cols))
    names = [f"_z{i}" for i in range(len(cols))]
    keyed = _ranked(df, cols, bits).withColumn("_z", z_value(names, bits)).drop(*names)
    return range_partitioned(keyed, [folder, "_z"], files).drop("_z")


def _has(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where)
