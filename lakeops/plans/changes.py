"""Row-level changes, change feeds and slowly changing dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.operators import cdc, mutate
from lakeops.operators.refresh import Kept
from lakeops.operators.versions import as_of_version
from lakeops.plans.bindings import MONEY, Tables, as_double, ntz, order_events
from lakeops.plans.registry import query
from lakeops.plans.sql import EVENTS, KEYED
from lakeops.streaming import merge
from lakeops.streaming.io import finish, read_stream

LOG_COLUMNS = ["order_number", "customer_name", "state", "line_total"]
KEY = ["order_number"]


def order_log(t: Tables) -> DataFrame:
    """A change log of the orders, from one scan.

    v0 inserts the orders before 2000, v1 the later ones; v2 takes 10 % off those of one state; v3
    deletes those then below 20,000.
    """
    cut = F.when(F.col("state") == "NATION_7", F.round(F.col("line_total") * F.lit("0.9").cast("decimal(3,2)"), 2)
                 .cast(MONEY)).otherwise(F.col("line_total"))

    def row(kind: str, version: Column, total: Column) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), version.cast("bigint").alias("_commit_version"),
                        total.alias("_total"))

    early = F.col("order_datetime_ts") < F.lit("2000-01-01").cast("timestamp_ntz")
    total, cheaper = F.col("line_total"), F.col("state") == "NATION_7"
    rows = F.array_compact(F.array(
        row("insert", F.when(early, 0).otherwise(1), total),
        F.when(cheaper, row("update_preimage", F.lit(2), total)),
        F.when(cheaper, row("update_postimage", F.lit(2), cut)),
        F.when(cut < 20000, row("delete", F.lit(3), cut))))
    at = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("_r._commit_version").cast("int"))
    return t.keyed_orders().select(*LOG_COLUMNS, F.explode(rows).alias("_r")).select(
        *LOG_COLUMNS[:-1], F.col("_r._total").alias("line_total"), "_r._change_type", "_r._commit_version",
        at.alias("_commit_timestamp"))


LOG = KEYED + """,
cut AS (SELECT *, CASE WHEN state = 'NATION_7' THEN CAST(line_total * 0.9 AS DECIMAL(12,2)) ELSE line_total END AS new_total
        FROM keyed),
log AS (
  SELECT order_number, customer_name, state, line_total, 'insert' AS _change_type,
         CAST(CASE WHEN order_datetime_ts < TIMESTAMP '2000-01-01' THEN 0 ELSE 1 END AS BIGINT) AS _commit_version FROM cut
  UNION ALL SELECT order_number, customer_name, state, line_total, 'update_preimage', 2 FROM cut WHERE state = 'NATION_7'
  UNION ALL SELECT order_number, customer_name, state, new_total, 'update_postimage', 2 FROM cut WHERE state = 'NATION_7'
  UNION ALL SELECT order_number, customer_name, state, new_total, 'delete', 3 FROM cut WHERE new_total < 20000)"""

AT = "TIMESTAMP '2024-01-01' + to_days(CAST(_commit_version AS INTEGER)) AS _commit_timestamp"
CHANGE_COLUMNS = f"order_number, customer_name, state, CAST(line_total AS DOUBLE) AS line_total, _change_type, _commit_version, {AT}"

# The table at each version, in SQL.
STATE_1 = "SELECT order_number, customer_name, state, CAST(line_total AS DOUBLE) AS line_total FROM cut"
STATE_2 = "SELECT order_number, customer_name, state, CAST(new_total AS DOUBLE) AS line_total FROM cut"
STATE_0 = STATE_1 + " WHERE order_datetime_ts < TIMESTAMP '2000-01-01'"
STATE_3 = STATE_2 + " WHERE new_total >= 20000"


@query("update_where", f"""WITH {KEYED}
SELECT order_number, state,
       CASE WHEN state = 'NATION_7' AND line_total > 200000 THEN 'H' ELSE status END AS status,
       CAST(CASE WHEN state = 'NATION_7' THEN CAST(line_total * 0.9 AS DECIMAL(12,2)) ELSE line_total END AS DOUBLE) AS line_total
FROM keyed""")
def update_where(t: Tables) -> DataFrame:
    orders = t.keyed_orders().select("order_number", "state", "status", "line_total")
    return as_double(mutate.update_where(orders, {
        "line_total": "line_total * 0.9",
        "status": "CASE WHEN line_total > 200000 THEN 'H' ELSE status END",
    }, "state = 'NATION_7'"))


@query("update_case", f"""WITH {KEYED}
SELECT order_number, state, CASE WHEN state = 'NATION_7' THEN 0.10 WHEN state = 'NATION_13' THEN 0.05 ELSE 0.0 END::DOUBLE
         AS discount_applied, TIMESTAMP '2024-03-01 12:00:00' AS last_updated
FROM keyed""")
def update_case(t: Tables) -> DataFrame:
    orders = t.keyed_orders().select("order_number", "state")
    return mutate.update_where(orders, {
        "discount_applied": "CASE WHEN state = 'NATION_7' THEN 0.10D WHEN state = 'NATION_13' THEN 0.05D ELSE 0.0D END",
        "last_updated": "timestamp_ntz'2024-03-01 12:00:00'",
    })


@query("delete_where", f"""WITH {KEYED}
SELECT order_number, state, CAST(line_total AS DOUBLE) AS line_total FROM keyed WHERE NOT (line_total < 10000)""")
def delete_where(t: Tables) -> DataFrame:
    return as_double(mutate.delete_where(t.keyed_orders().select("order_number", "state", "line_total"),
                                         "line_total < 10000"))


_MERGED = ["order_number", "state", "loyalty_segment", "line_total"]


@query("merge_upsert", f"""WITH {KEYED},
target AS (SELECT * FROM keyed WHERE order_datetime_ts < TIMESTAMP '2000-01-01'),
source AS (SELECT order_number, state, 'Platinum' AS loyalty_segment, CAST(line_total * 1.1 AS DECIMAL(12,2)) AS line_total
           FROM keyed WHERE status = 'O')
SELECT t.order_number, t.state, coalesce(s.loyalty_segment, t.loyalty_segment) AS loyalty_segment,
       CAST(coalesce(s.line_total, t.line_total) AS DOUBLE) AS line_total
FROM target t LEFT JOIN source s ON t.order_number = s.order_number AND t.state = s.state
UNION ALL
SELECT order_number, state, loyalty_segment, CAST(line_total AS DOUBLE) FROM source s
WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.order_number = s.order_number AND t.state = s.state)""")
def merge_upsert(t: Tables) -> DataFrame:
    target = t.keyed_orders().where("order_datetime_ts < timestamp_ntz'2000-01-01'").select(*_MERGED)
    source = t.keyed_orders().where("status = 'O'").select(
        "order_number", "state", F.lit("Platinum").alias("loyalty_segment"),
        F.expr("CAST(line_total * 1.1 AS DECIMAL(12,2))").alias("line_total"))
    return as_double(mutate.merge(target, source, ["order_number", "state"], {
        "loyalty_segment": "source.loyalty_segment", "line_total": "source.line_total"}))


@query("latest_per_key", f"""WITH {EVENTS}
SELECT user_id, event_id, event_time, state, CAST(line_total AS DOUBLE) AS line_total
FROM ev QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_time DESC, event_id DESC) = 1""")
def latest_per_key(t: Tables) -> DataFrame:
    newest = mutate.latest_per_key(t.events(), ["user_id"], ["event_time", "event_id"])
    return as_double(newest.withColumn("event_time", ntz("event_time")))


def _snapshots(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Two states of the orders: before 2000, and from 1996 on with one state 10 % off."""
    orders = t.keyed_orders()
    before = orders.where("order_datetime_ts < timestamp_ntz'2000-01-01'").select(*LOG_COLUMNS)
    after = mutate.update_where(
        orders.where("order_datetime_ts >= timestamp_ntz'1996-01-01'").select(*LOG_COLUMNS),
        {"line_total": "line_total * 0.9"}, "state = 'NATION_7'")
    return before, after


_SNAPSHOTS = KEYED + """,
b AS (SELECT order_number, customer_name, state, line_total FROM keyed WHERE order_datetime_ts < TIMESTAMP '2000-01-01'),
a AS (SELECT order_number, customer_name, state,
             CASE WHEN state = 'NATION_7' THEN CAST(line_total * 0.9 AS DECIMAL(12,2)) ELSE line_total END AS line_total
      FROM keyed WHERE order_datetime_ts >= TIMESTAMP '1996-01-01')"""


@query("change_counts", f"""WITH {_SNAPSHOTS}
SELECT count(b.order_number) AS before_count, count(a.order_number) AS after_count,
       count(*) FILTER (WHERE b.order_number IS NULL) AS inserted,
       count(*) FILTER (WHERE b.line_total <> a.line_total) AS updated,
       count(*) FILTER (WHERE a.order_number IS NULL) AS deleted
FROM b FULL JOIN a ON a.order_number = b.order_number""")
def change_counts(t: Tables) -> DataFrame:
    return mutate.change_counts(*_snapshots(t), KEY)


@query("change_feed", f"""WITH {_SNAPSHOTS},
pairs AS (SELECT b AS old, a AS new FROM b FULL JOIN a ON a.order_number = b.order_number),
feed AS (
  SELECT new AS r, 'insert' AS _change_type FROM pairs WHERE old.order_number IS NULL
  UNION ALL SELECT old, 'delete' FROM pairs WHERE new.order_number IS NULL
  UNION ALL SELECT old, 'update_preimage' FROM pairs WHERE old.line_total <> new.line_total
  UNION ALL SELECT new, 'update_postimage' FROM pairs WHERE old.line_total <> new.line_total)
SELECT r.order_number AS order_number, r.customer_name AS customer_name, r.state AS state,
       CAST(r.line_total AS DOUBLE) AS line_total, _change_type FROM feed""")
def change_feed(t: Tables) -> DataFrame:
    return as_double(cdc.change_feed(*_snapshots(t), KEY))


@query("changes_since", f"""WITH {LOG} SELECT {CHANGE_COLUMNS} FROM log WHERE _commit_version BETWEEN 1 AND 2""")
def changes_since(t: Tables) -> DataFrame:
    return as_double(cdc.read_changes(order_log(t), from_version=1, to_ts="2024-01-03 12:00:00"))


@query("changes_by_type", f"""WITH {LOG} SELECT _change_type, count(*) AS count FROM log GROUP BY _change_type""")
def changes_by_type(t: Tables) -> DataFrame:
    return cdc.changes_by_type(order_log(t))


@query("apply_changes", f"WITH {LOG} {STATE_3}")
def apply_changes(t: Tables) -> DataFrame:
    target = t.keyed_orders().select(*LOG_COLUMNS)
    return as_double(cdc.apply_changes(target, cdc.read_changes(order_log(t), from_version=2), KEY))


@query("apply_feed", f"""WITH {_SNAPSHOTS}, both_sides AS (SELECT min(b.order_number) AS k FROM b JOIN a ON a.order_number = b.order_number)
SELECT nullif(order_number, k) AS order_number, customer_name, state, CAST(line_total AS DOUBLE) AS line_total FROM a, both_sides""")
def apply_feed(t: Tables) -> DataFrame:
    """The feed between two snapshots, applied to the first, gives the second, with a NULL key among them."""
    before, after = _snapshots(t)
    first = before.join(after, "order_number", "left_semi").agg(F.min("order_number").alias("k")).first()["k"]

    def keyless(orders: DataFrame) -> DataFrame:
        return orders.withColumn("order_number", F.nullif("order_number", F.lit(first)))

    a, b = keyless(before), keyless(after)
    feed = cdc.change_feed(a, b, KEY).withColumn("_commit_version", F.lit(1))
    return as_double(cdc.apply_changes(a, feed, KEY))


@query("audit_log", f"""WITH {LOG}
SELECT order_number, _change_type, {AT}, 'auditor' AS changed_by FROM log WHERE _commit_version >= 2""")
def audit_log(t: Tables) -> DataFrame:
    return cdc.audit_log(cdc.read_changes(order_log(t), from_version=2), KEY, F.lit("auditor"))


@query("cdc_ops", f"""WITH {EVENTS}
SELECT event_id, CASE WHEN day(event_time) % 2 = 0 THEN 'INSERT' ELSE 'UPDATE' END AS operation,
       CAST(CASE WHEN day(event_time) % 2 = 0 THEN line_total ELSE CAST(line_total * 0.95 AS DECIMAL(12,2)) END AS DOUBLE)
         AS updated_line_total
FROM ev""")
def cdc_ops(t: Tables) -> DataFrame:
    return as_double(day_operations(t.events()).select("event_id", "operation", "updated_line_total"))


def day_operations(events: DataFrame) -> DataFrame:
    """Events of even days are inserts, those of odd days updates at 95 % of the value."""
    return cdc.derive_operations(events, F.dayofmonth("event_time") % 2 == 0, "line_total", "0.95")


_SCD1 = f"""WITH {EVENTS}
SELECT user_id, event_id, event_time, state, CAST(line_total AS DOUBLE) AS line_total
FROM (SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_time DESC, event_id DESC) = 1)
WHERE state <> 'error'"""


@query("scd1", _SCD1)
def scd1(t: Tables) -> DataFrame:
    current = cdc.scd1(t.events(), ["user_id"], ["event_time", "event_id"], "state = 'error'")
    return as_double(current.withColumn("event_time", ntz("event_time")))


_SCD2 = f"""WITH {EVENTS},
seen AS (SELECT *, state = 'error' AS gone, lag(state) OVER (PARTITION BY user_id ORDER BY event_time, event_id) AS prev FROM ev),
turns AS (SELECT * FROM seen WHERE prev IS NULL OR prev <> state),
spans AS (SELECT *, lead(event_time) OVER (PARTITION BY user_id ORDER BY event_time, event_id) AS _end_at FROM turns)
SELECT user_id, state, event_time AS _start_at, _end_at, _end_at IS NULL AS _is_current FROM spans WHERE NOT gone"""


@query("scd2", _SCD2)
def scd2(t: Tables) -> DataFrame:
    out = cdc.scd2(t.events(), ["user_id"], ["event_time", "event_id"], ["state"], "state = 'error'")
    return out.withColumns({c: ntz(c) for c in ("_start_at", "_end_at")})


def _arrivals(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The events as two batches, the second with many rows older than the first one's."""
    return t.events().where("event_id % 3 <> 1"), t.events().where("event_id % 3 = 1")


@query("scd1_incremental", _SCD1)
def scd1_incremental(t: Tables) -> DataFrame:
    first, second = _arrivals(t)
    keys, seq = ["user_id"], ["event_time", "event_id"]
    path = t.scratch("scd1")
    cdc.scd1_state(first, keys, seq).write.parquet(path)
    state = cdc.scd1_apply(t.spark.read.parquet(path), second, keys, seq)
    return as_double(state.where("state <> 'error'").withColumn("event_time", ntz("event_time")))


_HISTORY = {"keys": ["user_id"], "seq": ["event_time", "event_id"], "columns": ["state"], "delete_when": "state = 'error'"}


@query("scd2_incremental", _SCD2)
def scd2_incremental(t: Tables) -> DataFrame:
    first, second = _arrivals(t)
    path = t.scratch("scd2")
    cdc.scd2_state(first, **_HISTORY).write.parquet(path)
    state = cdc.scd2_apply(t.spark.read.parquet(path), second, **_HISTORY)
    return _history(state)


def _history(state: DataFrame) -> DataFrame:
    out = cdc.scd2_history(state, _HISTORY["keys"], _HISTORY["seq"], _HISTORY["columns"])
    return out.withColumns({c: ntz(c) for c in ("_start_at", "_end_at")})


@query("scd2_stream", _SCD2)
def scd2_stream(t: Tables) -> DataFrame:
    """The history of a stream whose batches come out of order, folded once on the way."""
    landing, path, check = t.scratch("scd2-landing"), t.scratch("scd2-state"), t.scratch("scd2-checkpoint")
    events = t.read("events")
    keys, seq = _HISTORY["keys"], _HISTORY["seq"]
    # Every third event comes late; the last batch repeats rows of the first.
    batches = [events.where("event_id % 3 <> 1"), events.where("event_id % 3 = 1 AND event_id % 2 = 0"),
               events.where("event_id % 3 = 1 AND event_id % 2 = 1").unionByName(events.where("event_id % 3 = 0"))]
    for k, batch in enumerate(batches):
        batch.write.mode("append").parquet(landing)
        stream = order_events(read_stream(t.spark, landing, events.schema, fmt="parquet"))
        finish(merge.stream_scd2(stream, path, keys, seq, _HISTORY["columns"], _HISTORY["delete_when"], check))
        if k == 1:
            folded = t.scratch("scd2-folded")
            merge.compact_scd2(t.spark, path, folded, keys, seq)
            path = folded
    return _history(merge.scd2_stored(t.spark, path, keys, seq))


_GOLD = Kept(["state"], sums=["line_total"], extremes=["line_total"], distinct="customer_name")


@query("gold_refreshed", f"""WITH {LOG}
SELECT state, count(*) AS orders, CAST(sum(new_total) AS DOUBLE) AS revenue, CAST(min(new_total) AS DOUBLE) AS least,
       CAST(max(new_total) AS DOUBLE) AS greatest, count(DISTINCT customer_name) AS customers
FROM cut WHERE new_total >= 20000 GROUP BY state""")
def gold_refreshed(t: Tables) -> DataFrame:
    """Aggregates of the first commit, brought up to date with those of the next three."""
    path = t.scratch("gold-log")
    order_log(t).write.partitionBy("_commit_version").parquet(path)
    log = t.spark.read.parquet(path).withColumn("_commit_version", F.col("_commit_version").cast("bigint"))
    first = as_of_version(log, KEY, 0, oldest=0)
    groups, values = mutate.kept_still(_GOLD.groups(first)), mutate.kept_still(_GOLD.values(first))
    for version in (1, 2, 3):
        step = cdc.read_changes(log, version, version)
        groups, values = _GOLD.refreshed(groups, values, step, as_of_version(log, KEY, version, oldest=0))
        groups, values = mutate.kept_still(groups), mutate.kept_still(values)
    return as_double(groups.select("state", F.col("n").alias("orders"), F.col("sum_line_total").alias("revenue"),
                                   F.col("min_line_total").alias("least"), F.col("max_line_total").alias("greatest"),
                                   F.col("distinct").alias("customers")))
