"""Named tables: create, append by name, external and managed copies, statistics, caching."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeops.operators import mutate
from lakeops.operators.rules import check_schema
from lakeops.operators.skew import broadcast_if_small


def database(spark: SparkSession, name: str, location: str) -> str:
    """Make a database whose managed tables live under a shared location."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")
    return name


def save_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Create a managed table, or make `df`, which may read it, the content of the table of that name.

    A table with the same columns and partitioning is published (see `publish`). Else the rows are written to a new folder
    first, and only then the table makes way for one at that folder (whose files stay if it is dropped): a failing write
    leaves the old table as it was.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.write.partitionBy(*partition_by).saveAsTable(table)
        return spark.table(table)
    old_by = partition_columns(spark, table)
    if sorted(source_names(spark.table(table))) == sorted(source_names(df)) and list(partition_by or old_by) == old_by:
        return publish(df, table)
    path = _snapshot_path(spark, table)
    df.write.partitionBy(*partition_by).parquet(path)
    spark.sql(f"DROP TABLE {table}")
    spark.createDataFrame([], df.schema).write.partitionBy(*partition_by).option("path", f"{path}-head").saveAsTable(table)
    return _led_to(spark, table, path)


def _led_to(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The table with the rows of a folder as its content, all others left aside."""
    if partition_columns(spark, table):
        _switch(spark, table, path, partitions_listed(spark, table))
    else:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def source_names(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _snapshot_path(spark: SparkSession, table: str) -> str:
    base = re.sub("-snapshot-[0-9a-f]{12}(-head)?$", "", location(spark, table))
    return f"{base}-snapshot-{uuid.uuid4().hex[:12]}"


def publish(df: DataFrame, table: str) -> DataFrame:
    """Make `df`, which may read the table itself, its new content.

    The rows go to a new folder beside the present one, and the name is switched to it when all are
    written: a failure before that leaves the table as it was, and readers of the old folder go on. Of a partitioned table
    each partition is switched by itself.
    Old folders are left for the owner to expire. `df` has the table's columns.
    """
    spark = df.sparkSession
    check_schema(df, spark.table(table).schema)
    by = partition_columns(spark, table)
    path = _snapshot_path(spark, table)
    df.select(*spark.table(table).columns).write.partitionBy(*by).parquet(path)
    return _led_to(spark, table, path)


Spec = tuple  # the values of a table's partition columns


def partitions(df: DataFrame, by: Sequence[str]) -> set[Spec]:
    """The partitions that some rows lie in, as texts: a row for each comes to the driver, which lists partitions anyway."""
    return {tuple(r) for r in df.select(*[F.col(f"`{c}`").cast("string") for c in by]).distinct().collect()}


def _within(by: Sequence[str], specs: Iterable[Spec]) -> Column:
    """Whether a row lies in one of the partitions: a filter of partition columns only, so that others aren't read."""
    texts = [F.col(f"`{c}`").cast("string") for c in by]

    def one(column: Column, values: list) -> Column:
        some = column.isin([v for v in values if v is not None])
        return some | column.isNull() if None in values else F.coalesce(some, F.lit(False))

    specs = list(specs)
    if not specs:
        return F.lit(False)
    if len(by) == 1:
        return one(texts[0], [s[0] for s in specs])
    # Grouped by the first columns, so that the filter has a term for each of their values only.
    heads: dict[Spec, list] = {}
    for s in specs:
        heads.setdefault(s[:-1], []).append(s[-1])
    return reduce(lambda a, b: a | b, [
        reduce(lambda a, b: a & b, [c.eqNullSafe(F.lit(v)) for c, v in zip(texts, head)]) & one(texts[-1], lasts)
        for head, lasts in heads.items()])


def _spec_sql(by: Sequence[str], spec: Spec) -> str:
    values = ["NULL" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in spec]
    return "PARTITION (" + ", ".join(f"`{c}` = {v}" for c, v in zip(by, values)) + ")"


def _switch(spark: SparkSession, table: str, path: str, replaced: set[Spec]) -> None:
    """Lead each partition found under `path` there, and drop those of `replaced` that aren't."""
    by = partition_columns(spark, table)
    texts = [F.col(f"`{c}`").cast("string").alias(c) for c in by]
    folder = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1).alias("_folder")
    schema = spark.table(table).schema
    staged = {tuple(r)[:-1]: unquote(r["_folder"]) for r in spark.read.schema(schema).parquet(path).select(*texts, folder).distinct().collect()}
    present = partitions_listed(spark, table)
    empty = f"{path}/_empty"
    for spec, where in staged.items():
        if spec in present:
            spark.sql(f"ALTER TABLE {table} {_spec_sql(by, spec)} SET LOCATION '{where}'")
        else:
            spark.sql(f"ALTER TABLE {table} ADD {_spec_sql(by, spec)} LOCATION '{where}'")
    for spec in (replaced & present) - staged.keys():
        # Dropping a managed table's partition deletes its folder, which readers may still use: lead it elsewhere first.
        spark.sql(f"ALTER TABLE {table} {_spec_sql(by, spec)} SET LOCATION '{empty}'")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_spec_sql(by, spec)}")


def partitions_listed(spark: SparkSession, table: str) -> set[Spec]:
    """The partitions the catalog lists, empty ones, too."""
    by = partition_columns(spark, table)
    out = set()
    for r in spark.sql(f"SHOW PARTITIONS {table}").collect():
        values = dict(part.split("=", 1) for part in r["partition"].split("/"))
        out.add(tuple(None if values[c] == "__HIVE_DEFAULT_PARTITION__" else unquote(values[c]) for c in by))
    return out


def replace_partitions(spark: SparkSession, table: str, touched: DataFrame, rewrite: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rewrite the rows of some partitions of a table; the others keep their files.

    `touched` has the partition columns of every row that `rewrite` would change or drop. The partitions' new rows go to a
    new folder; where some move to, or are new in, further partitions, the rows these hold are copied beside them. Then the
    partitions are led there, one by one, and those left without rows are dropped.
    """
    by, present = partition_columns(spark, table), spark.table(table)
    hit = partitions(touched, by)
    path = _snapshot_path(spark, table)
    new = rewrite(present.where(_within(by, hit))).select(*present.columns)
    check_schema(new, present.schema).write.partitionBy(*by).parquet(path)
    entered = (partitions(spark.read.schema(present.schema).parquet(path), by) - hit) & partitions_listed(spark, table)
    if entered:
        present.where(_within(by, entered)).write.mode("append").partitionBy(*by).parquet(path)
    _switch(spark, table, path, hit)
    spark.catalog.refreshTable(table)
    return spark.table(table)


def update_table(spark: SparkSession, table: str, set: Mapping[str, Column | str], where: Column | str | None = None) -> DataFrame:
    """UPDATE: `mutate.update_where`, published. Of a partitioned table, only partitions with rows it meets are read and rewritten."""
    rows = spark.table(table)
    if where is None or not partition_columns(spark, table):
        return publish(mutate.update_where(rows, set, where), table)
    return replace_partitions(spark, table, rows.where(where), lambda part: mutate.update_where(part, set, where))


def delete_table(spark: SparkSession, table: str, where: Column | str) -> DataFrame:
    """DELETE: `mutate.delete_where`, published; of a partitioned table, as `update_table`."""
    rows = spark.table(table)
    if not partition_columns(spark, table):
        return publish(mutate.delete_where(rows, where), table)
    return replace_partitions(spark, table, rows.where(where), lambda part: mutate.delete_where(part, where))


def merge_table(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str], **how) -> DataFrame:
    """MERGE: `mutate.merge`, published.

    Of a partitioned table, the partitions that hold keys of the source are found by a semi join, which reads keys only; they and those that
    rows are inserted into or move to are rewritten.
    """
    rows = spark.table(table)
    by = partition_columns(spark, table)
    if not by:
        return publish(mutate.merge(rows, source, keys, **how), table)
    source = mutate.kept_still(source)
    wanted = broadcast_if_small(source.select(*keys).distinct())
    met = rows.select(*dict.fromkeys([*by, *keys])).join(wanted, list(keys), "left_semi")
    return replace_partitions(spark, table, met, lambda part: mutate.merge(part, source, keys, **how))


def append(df: DataFrame, table: str) -> DataFrame:
    """Append rows, matching columns by name; raises if names or types do not fit the table."""
    spark = df.sparkSession
    check_schema(df, spark.table(table).schema).write.mode("append").saveAsTable(table)
    return spark.table(table)


def external_table(df: DataFrame, table: str, location: str) -> DataFrame:
    """Write rows to a location and name it as an external table."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(location)
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{location}'")
    return spark.table(table)


def to_managed(spark: SparkSession, external: str, managed: str) -> DataFrame:
    """Copy an external table into a managed one."""
    spark.sql(f"CREATE TABLE {managed} USING parquet AS SELECT * FROM {external}")
    return spark.table(managed)


def add_columns(spark: SparkSession, table: str, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Add typed, commented columns; rows written before read NULL."""
    listed = ", ".join(f"{name} {kind} COMMENT '{note}'" for name, (kind, note) in columns.items())
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({listed})")
    return spark.table(table)


def analyze(spark: SparkSession, table: str, histograms: bool = False) -> None:
    """Collect table and column statistics for the optimizer; with `histograms`, equi-height ones of its columns, too."""
    with _settings(spark, {"spark.sql.statistics.histogram.enabled": str(histograms).lower()}):
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


@contextmanager
def _settings(spark: SparkSession, values: Mapping[str, str]):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@contextmanager
def cost_based(spark: SparkSession):
    """Plan by the statistics of analysed tables while the block runs: sizes after filters, and the order of joins."""
    with _settings(spark, {"spark.sql.cbo.enabled": "true", "spark.sql.cbo.joinReorder.enabled": "true",
                           "spark.sql.cbo.planStats.enabled": "true"}):
        yield


@contextmanager
def cached(spark: SparkSession, table: str):
    """Keep a table in executor memory (spilling to disk) while the block runs."""
    spark.sql(f"CACHE TABLE {table}")
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"UNCACHE TABLE {table}")


def timed(action: Callable[[], object]) -> tuple[float, object]:
    """Seconds an action takes, and its result."""
    start = time.perf_counter()
    out = action()
    return time.perf_counter() - start, out
