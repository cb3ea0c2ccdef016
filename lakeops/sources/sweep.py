"""Removing files that nothing names any more.

Changes publish tables to new folders and leave the old ones for readers that still use them. A sweep lists all files under a root,
takes away those that tables or logs name, and notes when it first saw each of the others. A later sweep removes what has been noted for
longer than the retention: time counts from when a file was seen to be without a name, not from when it was written, so that a
reader of a table just replaced has the whole retention to finish.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.session import scratch_dir

LEDGER = "_sweep"


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def files_under(spark: SparkSession, root: str) -> DataFrame:
    """Path and bytes of all files, listed by Spark; their contents aren't read. Names that begin with `_` or `.` are left out."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
            .select(F.col("path"), F.col("length").alias("bytes")))


def named_files(spark: SparkSession, tables: Sequence[str], paths: Sequence[str] = ()) -> DataFrame:
    """Paths of the files that tables, and folders of data kept by path, hold now: what planning a read lists, too."""
    found = {unquote(f) for t in tables for f in spark.table(t).inputFiles()}
    listed = spark.createDataFrame([(f,) for f in sorted(found)], "path string")
    for p in paths:
        listed = listed.unionByName(files_under(spark, p).select("path"))
    # Compared without the scheme: a local path may be file:/x or file:///x.
    return listed.select(_bare("path").alias("path")).distinct()


def _bare(column: str):
    return F.regexp_replace(column, "^[a-z0-9]+:/+", "/")


def sweep(spark: SparkSession, root: str, tables: Sequence[str], paths: Sequence[str] = (), retention_hours: float = 168,
          at: str | None = None, dry_run: bool = True) -> DataFrame:
    """The files under `root` (path, bytes, seen_at) that neither the tables nor the `paths` name, and that were noted for
    `retention_hours`; without `dry_run` they are removed.

    Every call notes what it sees, and forgets files that are named again. `at` is the time of the call (default: now). All tables and
    paths that use the root must be given.
    """
    now = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    loose = files_under(spark, root).join(named_files(spark, tables, paths).withColumnRenamed("path", "_named"),
                                          _bare("path") == F.col("_named"), "left_anti")
    fs, where = _file_system(spark, f"{root}/{LEDGER}")
    runs = sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []
    if runs:
        known = spark.read.schema("path string, bytes bigint, seen_at timestamp").parquet(f"{root}/{LEDGER}/{runs[-1]}")
        seen = known.select(F.col("path").alias("_path"), "seen_at")
        noted = loose.join(seen, F.col("path") == F.col("_path"), "left").select("path", "bytes", F.coalesce("seen_at", now).alias("seen_at"))
    else:
        noted = loose.withColumn("seen_at", now)
    run = f"{root}/{LEDGER}/{len(runs):08d}-{scratch_dir(spark, 'run').rsplit('-', 1)[1]}"
    noted.write.parquet(run)
    old = F.col("seen_at") + F.make_dt_interval(secs=F.lit(float(retention_hours) * 3600)) <= now
    doomed = spark.read.parquet(run).where(old)
    if not dry_run:
        for r in doomed.select("path").toLocalIterator():
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(r["path"]), False)
    return doomed
