"""Layout jobs on whole tables: the rows must come back unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeops.operators import layout
from lakeops.plans.bindings import Tables
from lakeops.plans.registry import query
from lakeops.session import path_bytes
from lakeops.sources import files

def _lines(t: Tables) -> DataFrame:
    return t.read("lineitem")


def file_count(t: Tables) -> int:
    """Files for a rewrite: one per `TARGET_BYTES` of the table, at least as many as cores to use."""
    size = path_bytes(t.spark, f"{t.dir}/lineitem.parquet")
    return max(t.spark.sparkContext.defaultParallelism, -(-size // layout.TARGET_BYTES))


def sorted_count(t: Tables, name: str) -> int:
    """Files for a table to be sorted into: `file_count`, or more where their rows would be too many for a task to sort."""
    return layout.sorted_files(t.read(name), file_count(t))


@query("compact_rows", "SELECT * FROM lineitem")
def compact_rows(t: Tables) -> DataFrame:
    small, big = t.scratch("small"), t.scratch("compacted")
    _lines(t).repartition(4 * file_count(t)).write.parquet(small)
    return layout.compact(t.spark, small, big)


@query("zorder_rows", "SELECT * FROM lineitem")
def zorder_rows(t: Tables) -> DataFrame:
    path = t.scratch("zorder")
    layout.zorder(_lines(t), ["l_partkey", "l_shipdate"], sorted_count(t, "lineitem")).write.parquet(path)
    return files.read_parquet(t.spark, path)


@query("cluster_rows", "SELECT * FROM orders")
def cluster_rows(t: Tables) -> DataFrame:
    path = t.scratch("clustered")
    layout.cluster_by(t.read("orders"), ["o_custkey"], sorted_count(t, "orders")).write.parquet(path)
    return files.read_parquet(t.spark, path)


@query("layout_report")
def layout_report(t: Tables) -> DataFrame:
    path = t.scratch("clustered")
    layout.cluster_by(_lines(t), ["l_shipdate"], sorted_count(t, "lineitem")).write.parquet(path)
    return layout.layout_report(t.spark, path, "l_shipdate")


@query("zorder_files", "SELECT count(*) AS rows, true AS by_name, true AS by_date FROM orders")
def zorder_files(t: Tables) -> DataFrame:
    """Whether Z-order by a text and a time lets a filter on either skip most of 64 files or more."""
    path, orders = t.scratch("zorder"), t.read("orders").join(
        t.read("customer").select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
    layout.zorder(orders, ["c_name", "o_orderdate"], layout.sorted_files(t.read("orders"), 64)).write.parquet(path)
    stored = t.spark.read.parquet(path).select("c_name", "o_orderdate", F.col("_metadata.file_path").alias("file"))
    files_of = lambda hit: F.count_distinct(F.when(hit, F.col("file"))) <= F.count_distinct("file") * 0.4
    return stored.agg(F.count(F.lit(1)).alias("rows"), files_of(F.col("c_name") == "Customer#000000007").alias("by_name"),
                      files_of(F.date_trunc("month", "o_orderdate") == F.lit("1997-03-01").cast("timestamp")).alias("by_date"))


@query("layout_check", """SELECT count(*) AS rows, min(l_shipdate) AS least, max(l_shipdate) AS greatest, true AS narrow
FROM lineitem""")
def layout_check(t: Tables) -> DataFrame:
    """The report's rows and range are those of the table, and clustered files overlap with few others."""
    return layout_report(t).agg(F.sum("rows").alias("rows"), F.min("min").alias("least"), F.max("max").alias("greatest"),
                                (F.max("overlaps") <= 2).alias("narrow"))


@query("partition_prune", "SELECT * FROM lineitem WHERE l_returnflag = 'R'")
def partition_prune(t: Tables) -> DataFrame:
    path = t.scratch("partitioned")
    files.write_table(_lines(t), path, partition_by=["l_returnflag"])
    return files.read_parquet(t.spark, path).where(F.col("l_returnflag") == "R")


def _by_status(t: Tables, path: str) -> int:
    """Orders in folders by status: those of F in overlapping files, those of O clustered by date. Returns how many files each."""
    orders = t.read("orders")
    parts = layout.sorted_files(orders, 4)
    orders.where("o_orderstatus <> 'O'").repartition(parts, "o_orderkey").write.partitionBy("o_orderstatus").parquet(path)
    dated = layout.cluster_by(orders.where("o_orderstatus = 'O'"), ["o_orderdate"], parts)
    dated.write.mode("append").partitionBy("o_orderstatus").parquet(path)
    return parts


@query("recluster_rows", "SELECT * FROM orders UNION ALL SELECT * REPLACE ('New' AS o_orderstatus) FROM orders WHERE o_orderstatus = 'F'")
def recluster_rows(t: Tables) -> DataFrame:
    """All rows are there after folders were clustered, more came, and these were clustered by other columns."""
    path, orders = t.scratch("recluster"), t.read("orders")
    parts = _by_status(t, path)
    layout.recluster(t.spark, path, "o_orderstatus", ["o_orderdate"])
    fresh = orders.where("o_orderstatus = 'F'").withColumn("o_orderstatus", F.lit("New"))
    fresh.repartition(parts, "o_orderkey").write.mode("append").partitionBy("o_orderstatus").parquet(path)
    layout.recluster(t.spark, path, "o_orderstatus", ["o_custkey", "o_orderdate"])
    return files.read_parquet(t.spark, path).select(*orders.columns)


@query("recluster_folders", """SELECT o_orderstatus AS folder, o_orderstatus <> 'O' AS first_run, false AS second_run, true AS narrow FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'New', false, true, true""")
def recluster_folders(t: Tables) -> DataFrame:
    """Which folders have other files after each of two runs, and whether the dates of the first one's files don't overlap."""
    path, orders = t.scratch("recluster"), t.read("orders")

    def listed(name: str) -> DataFrame:
        out = t.scratch(name)
        stored = t.spark.read.parquet(path).select(F.col("o_orderstatus").alias("folder"), F.col("_metadata.file_path").alias("file"))
        stored.groupBy("folder").agg(F.sort_array(F.collect_set("file")).alias(name)).write.parquet(out)  # a row per folder
        return t.spark.read.parquet(out)

    parts = _by_status(t, path)
    runs = [listed("start")]
    layout.recluster(t.spark, path, "o_orderstatus", ["o_orderdate"], target_bytes=1 << 20)
    depth = layout.overlap_depth(t.spark.read.parquet(path), "o_orderstatus", "o_orderdate").select("folder", (F.col("depth") <= 2).alias("narrow"))
    kept = t.scratch("depth")
    depth.write.parquet(kept)
    runs.append(listed("first"))
    fresh = orders.where("o_orderstatus = 'F'").withColumn("o_orderstatus", F.lit("New"))
    fresh.repartition(parts, "o_orderkey").write.mode("append").partitionBy("o_orderstatus").parquet(path)
    runs.append(listed("added"))
    layout.recluster(t.spark, path, "o_orderstatus", ["o_custkey", "o_orderdate"], target_bytes=1 << 20)
    runs.append(listed("second"))
    joined = runs[3].join(runs[0], "folder", "left").join(runs[1], "folder", "left").join(runs[2], "folder").join(t.spark.read.parquet(kept), "folder", "left")
    return joined.select("folder", F.coalesce(F.col("start") != F.col("first"), F.lit(False)).alias("first_run"),
                         (F.col("added") != F.col("second")).alias("second_run"), F.coalesce("narrow", F.lit(True)).alias("narrow"))
