"""Versioned tables: commits, time travel, restore, retention, clones."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from lakeops.operators import cdc, versions
from lakeops.plans.bindings import Tables, as_double
from lakeops.plans.changes import (
    AT,
    CHANGE_COLUMNS,
    KEY,
    LOG,
    LOG_COLUMNS,
    STATE_0,
    STATE_1,
    STATE_2,
    STATE_3,
    order_log,
)
from lakeops.plans.registry import query
from lakeops.streaming import changes
from lakeops.streaming.io import finish


def committed(t: Tables) -> str:
    """The folder of a log of four commits, each read back from the log before the next."""
    path = t.scratch("log")
    orders = t.keyed_orders()
    early = "order_datetime_ts < timestamp_ntz'2000-01-01'"

    def newest(version: int) -> DataFrame:
        return versions.as_of_version(versions.read_log(t.spark, path), KEY, version)

    versions.commit(path, cdc.insert_changes(orders.where(early).select(*LOG_COLUMNS)), 0, "2024-01-01")
    versions.commit(path, cdc.insert_changes(orders.where(f"NOT ({early})").select(*LOG_COLUMNS)), 1, "2024-01-02")
    versions.commit(path, cdc.update_changes(newest(1), {"line_total": "line_total * 0.9"}, "state = 'NATION_7'"),
                    2, "2024-01-03")
    versions.commit(path, cdc.delete_changes(newest(2), "line_total < 20000"), 3, "2024-01-04")
    return path


@query("commit_log", f"WITH {LOG} SELECT {CHANGE_COLUMNS} FROM log")
def commit_log(t: Tables) -> DataFrame:
    return as_double(versions.read_log(t.spark, committed(t)))


@query("as_of_version", f"WITH {LOG} {STATE_2}")
def as_of_version(t: Tables) -> DataFrame:
    return as_double(versions.as_of_version(order_log(t), KEY, 2, oldest=0))


@query("as_of_timestamp", f"WITH {LOG} {STATE_0}")
def as_of_timestamp(t: Tables) -> DataFrame:
    path = committed(t)
    return as_double(versions.as_of_timestamp(versions.read_log(t.spark, path), KEY, "2024-01-01 18:30:00",
                                              versions.commits(t.spark, path)))


@query("history", f"""WITH {LOG}
SELECT _commit_version AS version, {AT.replace('AS _commit_timestamp', 'AS timestamp')},
       count(*) FILTER (WHERE _change_type = 'insert') AS inserted_rows,
       count(*) FILTER (WHERE _change_type = 'update_postimage') AS updated_rows,
       count(*) FILTER (WHERE _change_type = 'delete') AS deleted_rows,
       CASE _commit_version WHEN 2 THEN 'UPDATE' WHEN 3 THEN 'DELETE' ELSE 'WRITE' END AS operation
FROM log GROUP BY _commit_version""")
def history(t: Tables) -> DataFrame:
    path = committed(t)
    return versions.history(versions.read_log(t.spark, path), versions.commits(t.spark, path))


@query("version_counts", f"""WITH {LOG}
SELECT CAST(v AS BIGINT) AS version,
       (SELECT count(*) FROM log WHERE _commit_version <= v AND _change_type = 'insert')
       - (SELECT count(*) FROM log WHERE _commit_version <= v AND _change_type = 'delete') AS record_count
FROM (VALUES (0), (1), (2), (3)) x(v)""")
def version_counts(t: Tables) -> DataFrame:
    return versions.version_counts(order_log(t))


@query("diff_versions", f"""WITH {LOG}
SELECT order_number, CASE WHEN order_datetime_ts >= TIMESTAMP '2000-01-01' THEN 'added'
         WHEN new_total < 20000 THEN 'removed' ELSE 'changed' END AS change
FROM cut WHERE (order_datetime_ts >= TIMESTAMP '2000-01-01' AND new_total >= 20000)
  OR (order_datetime_ts < TIMESTAMP '2000-01-01' AND (new_total < 20000 OR new_total <> line_total))""")
def diff_versions(t: Tables) -> DataFrame:
    return versions.diff_versions(order_log(t), KEY, 0, 3).select("order_number", "change")


@query("restore_version", f"WITH {LOG} {STATE_1}")
def restore_version(t: Tables) -> DataFrame:
    """Back to version 1 by a commit 4; the log then gives version 1's rows as the newest."""
    path = t.scratch("log")
    log = order_log(t)
    log.write.partitionBy("_commit_version").parquet(path)
    stored = versions.read_log(t.spark, path)
    changes = versions.restore(stored, KEY, 1, as_version=4, ts="2024-01-05")
    versions.commit(path, changes.drop("_commit_version", "_commit_timestamp"), 4, "2024-01-05")
    return as_double(versions.as_of_version(versions.read_log(t.spark, path), KEY, 4, oldest=0))


@query("compact_log", f"""WITH {LOG}
SELECT order_number, customer_name, state, CAST(new_total AS DOUBLE) AS line_total, 'insert' AS _change_type,
       CAST(2 AS BIGINT) AS _commit_version, TIMESTAMP '2024-01-03' AS _commit_timestamp FROM cut
UNION ALL SELECT {CHANGE_COLUMNS} FROM log WHERE _commit_version = 3""")
def compact_log(t: Tables) -> DataFrame:
    return as_double(versions.compact_log(order_log(t), KEY, cutoff=2))


@query("clone_deep", f"WITH {LOG} {STATE_3}")
def clone_deep(t: Tables) -> DataFrame:
    return as_double(versions.clone(order_log(t), KEY, t.scratch("clone"), version=3))


@query("clone_at_version", f"WITH {LOG} {STATE_0}")
def clone_at_version(t: Tables) -> DataFrame:
    return as_double(versions.clone_view(order_log(t), KEY, f"clone_{uuid.uuid4().hex[:12]}", version=0))


@query("changes_stream", f"WITH {LOG} {STATE_3}")
def changes_stream(t: Tables) -> DataFrame:
    """The log read as a stream from version 1 on, in two runs with commits between them, one of these for the second time."""
    log, kept, check = t.scratch("stream-log"), t.scratch("applied"), t.scratch("applied-checkpoint")
    source = versions.read_log(t.spark, committed(t))
    at = {v: f"2024-01-0{v + 1}" for v in range(4)}

    def put(version: int) -> None:
        rows = cdc.read_changes(source, version, version).drop("_commit_version", "_commit_timestamp")
        versions.commit(log, rows, version, at[version])

    target = versions.as_of_version(source, KEY, 0)
    for batch in ((0, 1, 2), (3, 2)):
        for version in batch:
            put(version)
        stream = changes.stream_changes(t.spark, log, source.schema, from_version=1)
        finish(changes.stream_apply(stream, kept, KEY, check))
    return as_double(changes.applied(t.spark, target, kept, KEY))


@query("clone_writable", f"""WITH {LOG}
SELECT 'clone' AS side, order_number, customer_name, CASE WHEN state = 'NATION_3' THEN 'Elsewhere' ELSE state END AS state,
       CAST(line_total AS DOUBLE) AS line_total FROM cut
UNION ALL SELECT 'base', * FROM ({STATE_3})""")
def clone_writable(t: Tables) -> DataFrame:
    """A clone at version 1 with a commit of its own, and its base with two later ones: neither sees the other's."""
    base, path = committed(t), t.scratch("clone")
    rows = versions.clone_writable(t.spark, base, KEY, path, 1)
    versions.commit_clone(path, cdc.update_changes(rows, {"state": "'Elsewhere'"}, "state = 'NATION_3'"), 0, "2024-02-01")
    sides = {"clone": versions.read_clone(t.spark, path), "base": versions.as_of_version(versions.read_log(t.spark, base), KEY, 3)}
    both = [df.select(F.lit(name).alias("side"), *LOG_COLUMNS) for name, df in sides.items()]
    return as_double(both[0].unionByName(both[1]))
