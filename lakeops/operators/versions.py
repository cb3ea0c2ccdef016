"""Versioned tables as a change log: commit, time travel, history, restore, retention, clones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lakeops.functions import struct_of
from lakeops.operators.cdc import META, apply_changes, change_rows, image_columns, latest_changes
from lakeops.operators.mutate import differences


# The folder of a log that lists its commits; readers of the log skip names of this kind.
COMMITS = "_commits"


class VersionNotAvailable(LookupError):
    """The log holds no such version any more, or not yet."""


def stamp(changes: DataFrame, version: int, ts: str | Column) -> DataFrame:
    """Give change rows their commit columns."""
    at = F.lit(ts).cast("timestamp_ntz") if isinstance(ts, str) else ts
    return (changes.withColumn("_commit_version", F.lit(version).cast("bigint"))
            .withColumn("_commit_timestamp", at))


def commit(path: str, changes: DataFrame, version: int, ts: str | Column) -> None:
    """Write change rows as one version folder of a log, and a row in its list of commits.

    The folder is replaced as a whole, so a commit that is repeated after a failure leaves the log
    as one commit would, even if it has no change rows any more.
    """
    stamped = stamp(changes, version, ts)
    stamped.drop("_commit_version").write.mode("overwrite").parquet(f"{path}/_commit_version={version}")
    one = stamp(changes.sparkSession.range(1), version, ts).select("_commit_version", "_commit_timestamp")
    one.write.mode("overwrite").parquet(f"{path}/{COMMITS}/{version}")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log; its version is the partition column, so version filters prune folders."""
    return (spark.read.parquet(path)
            .withColumn("_commit_version", F.col("_commit_version").cast("bigint")))


def commits(spark: SparkSession, path: str) -> DataFrame:
    """Version and time of every commit, also of empty ones: a row each."""
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/{COMMITS}")


def version_at(commits: DataFrame, ts: str) -> int:
    """The newest version committed up to a time; reads a row per commit, not the log."""
    at = F.lit(ts).cast("timestamp_ntz")
    version = commits.where(F.col("_commit_timestamp") <= at).agg(F.max("_commit_version").alias("v")).first()["v"]
    if version is None:
        raise VersionNotAvailable(f"no commit up to {ts}")
    return version


def oldest_version(log: DataFrame) -> int | None:
    return log.agg(F.min("_commit_version").alias("v")).first()["v"]


def as_of_version(log: DataFrame, keys: Sequence[str], version: int,
                  oldest: int | None = None) -> DataFrame:
    """The table as it was at a version: the newest image of each key, without deleted keys.

    Raises if the log begins after that version; `oldest` saves looking that up.
    """
    first = oldest_version(log) if oldest is None else oldest
    if first is None or version < first:
        raise VersionNotAvailable(f"version {version}; the log begins at {first}")
    newest = latest_changes(log.where(F.col("_commit_version") <= version), keys)
    return newest.where(F.col("_change_type") != "delete").select(*image_columns(log))


def as_of_timestamp(log: DataFrame, keys: Sequence[str], ts: str, commits: DataFrame | None = None) -> DataFrame:
    """The table as it was at a time; raises if the first commit is later.

    With the list of `commits` the time becomes a version, and only its folders are read.
    """
    if commits is not None:
        first = commits.agg(F.min("_commit_version").alias("v")).first()["v"]
        return as_of_version(log, keys, version_at(commits, ts), oldest=first)
    at = F.lit(ts).cast("timestamp_ntz")
    if log.agg((F.min("_commit_timestamp") <= at).alias("ok")).first()["ok"] is not True:
        raise VersionNotAvailable(f"no commit up to {ts}")
    newest = latest_changes(log.where(F.col("_commit_timestamp") <= at), keys)
    return newest.where(F.col("_change_type") != "delete").select(*image_columns(log))


def history(log: DataFrame, commits: DataFrame | None = None) -> DataFrame:
    """Version, time, kind of operation and row counts of every commit, newest first.

    Commits without change rows are only known from the list of `commits`; their kind is EMPTY.
    """
    kinds = {"inserted_rows": "insert", "updated_rows": "update_postimage", "deleted_rows": "delete"}
    counts = log.groupBy(F.col("_commit_version").alias("version"),
                         F.col("_commit_timestamp").alias("timestamp")).agg(
        *[F.count_if(F.col("_change_type") == kind).alias(name) for name, kind in kinds.items()])
    if commits is not None:
        listed = commits.select(F.col("_commit_version").alias("version"), F.col("_commit_timestamp").alias("timestamp"))
        counts = listed.join(counts.drop("timestamp"), "version", "left").na.fill(0, list(kinds))
    some = {name: F.col(name) > 0 for name in kinds}
    operation = (F.when(some["inserted_rows"] & ~some["updated_rows"] & ~some["deleted_rows"], "WRITE")
                 .when(some["updated_rows"] & ~some["inserted_rows"] & ~some["deleted_rows"], "UPDATE")
                 .when(some["deleted_rows"] & ~some["inserted_rows"] & ~some["updated_rows"], "DELETE")
                 .when(some["inserted_rows"] | some["updated_rows"] | some["deleted_rows"], "MERGE")
                 .otherwise("EMPTY"))
    return counts.withColumn("operation", operation).orderBy(F.desc("version"))


def version_counts(log: DataFrame) -> DataFrame:
    """Rows of the table at every version: one pass over the log instead of one count per version."""
    step = F.when(F.col("_change_type") == "insert", 1).when(F.col("_change_type") == "delete", -1).otherwise(0)
    steps = log.groupBy(F.col("_commit_version").alias("version")).agg(F.sum(step).alias("_step"))
    so_far = Window.orderBy("version").rowsBetween(Window.unboundedPreceding, 0)  # a row per version
    return steps.select("version", F.sum("_step").over(so_far).alias("record_count"))


def _two_states(log: DataFrame, keys: Sequence[str], a: int | None, b: int | None) -> DataFrame:
    """Per key the images at two versions (None: newest), from one aggregation of the log."""
    rows = log.where(F.col("_change_type") != "update_preimage")
    columns = image_columns(log)

    def state(version: int | None) -> Column:
        seen = F.lit(True) if version is None else F.col("_commit_version") <= version
        return F.max_by(F.struct(F.col("_change_type"), struct_of(columns).alias("_image")),
                        F.when(seen, F.col("_commit_version")))

    def image(name: str) -> Column:
        return F.when(F.col(f"{name}._change_type") != "delete", F.col(f"{name}._image"))

    return (rows.groupBy(*keys).agg(state(a).alias("_a"), state(b).alias("_b"))
            .select(image("_a").alias("_before"), image("_b").alias("_after")))


def diff_versions(log: DataFrame, keys: Sequence[str], a: int, b: int) -> DataFrame:
    """What differs between two versions, row by row.

    Keys, `change` (added, removed, changed) and the names of the columns that changed.
    """
    return differences(_two_states(log, keys, a, b), keys, image_columns(log))


def restore(log: DataFrame, keys: Sequence[str], version: int, as_version: int,
            ts: str | Column) -> DataFrame:
    """Change rows that take the newest state back to a version, stamped as a new commit.

    Append them to the log: history stays, nothing is undone in place.
    """
    states = _two_states(log, keys, None, version)
    rows = F.explode(change_rows(F.col("_before"), F.col("_after")))
    changes = states.select(rows.alias("_r")).select("_r._image.*", "_r._change_type")
    return stamp(changes, as_version, ts).select(*log.columns)


def compact_log(log: DataFrame, keys: Sequence[str], cutoff: int) -> DataFrame:
    """Drop images no version from `cutoff` on needs.

    What is left: one `insert` per row alive at the cut-off, stamped with the cut-off, and all
    later changes. Reading a version before the cut-off raises.
    """
    old = F.col("_commit_version") <= cutoff
    kind = log.schema["_commit_timestamp"].dataType
    at = log.where(old).agg(F.max("_commit_timestamp").cast("string").alias("at")).first()["at"]
    newest = latest_changes(log.where(old), keys).where(F.col("_change_type") != "delete")
    base = (newest.withColumn("_change_type", F.lit("insert"))
            .withColumn("_commit_version", F.lit(cutoff).cast("bigint"))
            .withColumn("_commit_timestamp", F.lit(at).cast(kind)))
    return base.unionByName(log.where(~old)).select(*log.columns)


def clone(log: DataFrame, keys: Sequence[str], path: str, version: int) -> DataFrame:
    """Deep clone: an independent copy of the table at a version."""
    as_of_version(log, keys, version).write.mode("errorifexists").parquet(path)
    return log.sparkSession.read.parquet(path)


def clone_view(log: DataFrame, keys: Sequence[str], name: str, version: int) -> DataFrame:
    """Shallow clone: a named view of the table at a version; no data is copied."""
    as_of_version(log, keys, version).createOrReplaceTempView(name)
    return log.sparkSession.table(name)


BASE = "_base"


def clone_writable(spark: SparkSession, base: str, keys: Sequence[str], path: str, version: int) -> DataFrame:
    """Shallow clone that can be written to: a pointer to a log and a version, and a log of its own.

    No row is copied; the clone outlives the session. Later commits to the base aren't seen, those to the clone (`commit_clone`) stay
    with it. The base must keep the version: once `compact_log` has dropped it, reading the clone raises.
    """
    as_of_version(read_log(spark, base), keys, version)  # raises if there is none
    pointer = spark.createDataFrame([(base, version, list(keys))], "base string, version bigint, keys array<string>")
    pointer.coalesce(1).write.mode("errorifexists").parquet(f"{path}/{BASE}")
    return read_clone(spark, path)


def commit_clone(path: str, changes: DataFrame, version: int, ts: str | Column) -> None:
    """A commit to the clone's own log (`commit`)."""
    commit(f"{path}/log", changes, version, ts)


def read_clone(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The clone's rows: the base at its version, with the clone's commits (up to `version`) merged on read."""
    pointer = spark.read.parquet(f"{path}/{BASE}").first()
    rows = as_of_version(read_log(spark, pointer["base"]), pointer["keys"], pointer["version"])
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/log")
    if not where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where):
        return rows
    own = read_log(spark, f"{path}/log")
    return apply_changes(rows, own if version is None else own.where(F.col("_commit_version") <= version), pointer["keys"])


__all__ = ["clone_writable", "commit_clone", "read_clone",
           "META", "VersionNotAvailable", "as_of_timestamp", "as_of_version", "clone", "clone_view",
           "commit", "commits", "compact_log", "diff_versions", "history", "oldest_version", "read_log",
           "restore", "stamp", "version_at", "version_counts"]
