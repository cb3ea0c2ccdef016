"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the operators count on. UTC because the test tables hold zone-less times;
# the others keep skewed joins and stream state healthy on large inputs.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Hash instead of sort a shuffled join where every partition of one side is at most this big.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Rows are larger in memory than in compressed files: keeps broadcasts within their limit.
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # State may outgrow executor memory: RocksDB, uploading changes only, without row counting.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def build_session(master: str | None = None, app: str = "lakeops", **conf: str) -> SparkSession:
    """Create (or get) a session with `SETTINGS`; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


# One initial shuffle partition for this much input; adaptive execution merges the small ones.
BYTES_PER_PARTITION = 64 * 1024 * 1024
UTC = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def tune(spark: SparkSession, input_bytes: int = 0, bytes_per_partition: int = BYTES_PER_PARTITION) -> SparkSession:
    """Apply `SETTINGS` to a running session, leaving what its owner has set explicitly.

    `input_bytes`, the size of the tables to be read, sizes shuffles: they begin with a partition per
    `bytes_per_partition` of input (but never fewer than `spark.sql.shuffle.partitions`), since
    adaptive execution merges partitions but adds none. The zone-less times of the tables need UTC:
    a session whose owner has set another time zone raises.
    """
    owned = spark.sparkContext.getConf()
    zone = "spark.sql.session.timeZone"
    if owned.contains(zone) and owned.get(zone) not in UTC:
        raise ValueError(f"the session's time zone is {owned.get(zone)}; these queries need UTC")
    for key, value in SETTINGS.items():
        if not owned.contains(key):
            spark.conf.set(key, value)
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if not owned.contains(initial):
        wanted = input_bytes // bytes_per_partition
        spark.conf.set(initial, str(max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)))
    return spark


def path_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files under a path, from the file system's own summary."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return where.getFileSystem(conf).getContentSummary(where).getLength()


@functools.cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"lakeops-{application}-")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder name in the folder all executors share (`spark.checkpoint.dir`).

    Without that setting, only a session whose driver and executors are one process (`local[n]`)
    gets a folder of its own, next to its tables; others raise.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _own_folder(spark.sparkContext.applicationId)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
