"""Streaming queries, run on what the tables hold and then read back as a batch."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from lakeops.operators.mutate import latest_per_key
from lakeops.operators.rules import Rule
from lakeops.operators.sampling import split_into_batches
from lakeops.plans.bindings import Tables, as_double, ntz, order_events
from lakeops.plans.changes import day_operations
from lakeops.plans.quality import EXPECTATIONS, PASSED
from lakeops.plans.registry import query
from lakeops.plans.shaping import SILVER_COLUMNS, SILVER_SQL, clean_loans, paired_events
from lakeops.plans.sql import EVENTS, LOANS, avg2, total
from lakeops.plans.summaries import GOLD_STATE_SQL, by_grade, by_state, rounded_gold
from lakeops.session import path_bytes
from lakeops.sources import tables
from lakeops.streaming import medallion, merge, windows
from lakeops.streaming.io import (
    PARTS,
    finish,
    observed_counts,
    part_of,
    read_stream,
    write_stream,
    write_stream_clustered,
    write_stream_observed,
    write_stream_parts,
    write_stream_table,
)

DELAY = "10 minutes"


def run(t: Tables, stream: DataFrame, name: str) -> DataFrame:
    """Run an append stream to the end of its input and read what it wrote."""
    path = t.scratch(name)
    finish(write_stream(stream, path, t.scratch(f"{name}-checkpoint")))
    return t.spark.read.schema(stream.schema).parquet(path)


def _flat(windows_out: DataFrame) -> DataFrame:
    return as_double(windows.flatten_window(windows_out)
                     .withColumns({c: ntz(c) for c in ("window_start", "window_end")}))


_STATS = f"""count(*) AS order_count, {avg2('line_total')} AS avg_order_value, {total('line_total')} AS total_revenue"""

# In append mode a window is out once the watermark, the latest time less the delay, has passed its end.
_CLOSED = "(SELECT max(event_time) FROM ev) - INTERVAL 10 MINUTE"


@query("stream_append", f"""WITH {EVENTS}
SELECT event_id, event_time, user_id, state, CAST(line_total AS DOUBLE) AS line_total FROM ev""")
def stream_append(t: Tables) -> DataFrame:
    return as_double(run(t, t.event_stream(), "append").withColumn("event_time", ntz("event_time")))


@query("stream_tumbling", f"""WITH {EVENTS},
w AS (SELECT time_bucket(INTERVAL 1 HOUR, event_time) AS window_start, * FROM ev)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, state, {_STATS}
FROM w GROUP BY window_start, state HAVING window_start + INTERVAL 1 HOUR <= {_CLOSED}""")
def stream_tumbling(t: Tables) -> DataFrame:
    hourly = windows.tumbling(t.event_stream(), "event_time", "1 hour", ["state"],
                              windows.order_stats("line_total"), DELAY)
    return _flat(run(t, hourly, "tumbling"))


@query("stream_sliding", f"""WITH {EVENTS},
w AS (SELECT time_bucket(INTERVAL 1 MINUTE, event_time) - to_minutes(CAST(k AS INTEGER)) AS window_start, ev.*
      FROM ev CROSS JOIN range(5) r(k))
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, state, {_STATS}
FROM w GROUP BY window_start, state HAVING window_start + INTERVAL 5 MINUTE <= {_CLOSED}""")
def stream_sliding(t: Tables) -> DataFrame:
    moving = windows.sliding(t.event_stream(), "event_time", "5 minutes", "1 minute", ["state"],
                             windows.order_stats("line_total"), DELAY)
    return _flat(run(t, moving, "sliding"))


@query("stream_session", f"""WITH {EVENTS},
starts AS (SELECT *, CASE WHEN event_time - lag(event_time) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS first
           FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY event_time)),
islands AS (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY event_time) AS island FROM starts)
SELECT min(event_time) AS window_start, max(event_time) + INTERVAL 30 MINUTE AS window_end, user_id, {_STATS}
FROM islands GROUP BY user_id, island HAVING max(event_time) + INTERVAL 30 MINUTE <= {_CLOSED}""")
def stream_session(t: Tables) -> DataFrame:
    visits = windows.sessions(t.event_stream(), "event_time", "30 minutes", ["user_id"],
                              windows.order_stats("line_total"), DELAY)
    return _flat(run(t, visits, "session"))


@query("stream_interval_join", f"""WITH {EVENTS}
SELECT c.user_id, c.event_id AS click_id, c.event_time AS clicked_at, p.event_id AS purchase_id,
       p.event_time AS bought_at, CAST(p.line_total AS DOUBLE) AS paid
FROM ev c JOIN ev p ON c.user_id = p.user_id AND c.state = 'click' AND p.state = 'purchase'
 AND p.event_time BETWEEN c.event_time - INTERVAL 5 MINUTE AND c.event_time + INTERVAL 5 MINUTE""")
def stream_interval_join(t: Tables) -> DataFrame:
    pairs = paired_events(t.event_stream(), t.event_stream(), splits=4, delay=DELAY)
    return run(t, pairs, "pairs")


@query("bronze_ingest", "SELECT *, true AS stamped FROM orders")
def bronze_ingest(t: Tables) -> DataFrame:
    path = t.scratch("bronze")
    medallion.bronze(t.spark, t.stream_path("orders"), path, t.scratch("bronze-checkpoint"),
                     t.read("orders").schema)
    return (t.spark.read.parquet(path).withColumn("stamped", F.col("ingestion_timestamp").isNotNull())
            .drop("ingestion_timestamp"))


_DROPS = " AND ".join(PASSED[n] for n, (_, action) in EXPECTATIONS.items() if action == "drop")
_KEPT_LOANS = LOANS.replace("loans AS (", "all_loans AS (") + f",\nloans AS (SELECT * FROM all_loans WHERE {_DROPS})"


def _landing(t: Tables) -> tuple[str, DataFrame]:
    path = t.scratch("landing")
    t.loans().write.parquet(path)
    return path, t.spark.read.parquet(path)


@query("silver_stream", f"WITH {_KEPT_LOANS}, {SILVER_SQL} SELECT {SILVER_COLUMNS} FROM silver")
def silver_stream(t: Tables) -> DataFrame:
    path, landed = _landing(t)
    raw = read_stream(t.spark, path, landed.schema, fmt="parquet")
    clean = run(t, medallion.silver(raw, EXPECTATIONS, clean_loans), "silver")
    return as_double(clean.drop("processing_timestamp"))


@query("medallion_gold", f"WITH {_KEPT_LOANS}, {SILVER_SQL} {GOLD_STATE_SQL}")
def medallion_gold(t: Tables) -> DataFrame:
    path, landed = _landing(t)
    gold, _ = medallion.run_medallion(t.spark, path, t.scratch("medallion"), landed.schema, EXPECTATIONS, clean_loans,
                                      {"gold_by_state": by_state, "gold_by_grade": by_grade})
    return rounded_gold(gold["gold_by_state"])


_MERGE_KEYS = ["user_id", "day"]
_MERGE_SEQ = ["event_time", "event_id"]


@query("stream_cdc_merge", f"""WITH {EVENTS},
ops AS (SELECT *, strftime(event_time, '%Y-%m-%d') AS day,
               CASE WHEN day(event_time) % 2 = 0 THEN line_total ELSE CAST(line_total * 0.95 AS DECIMAL(12,2)) END AS updated
        FROM ev),
base AS (SELECT * FROM ops WHERE state = 'signup'
         QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY event_time DESC, event_id DESC) = 1),
stream AS (SELECT * FROM ops WHERE state <> 'signup'),
folded AS (
  SELECT user_id, day, count(*) AS n, arg_min(event_id, event_id) AS event_id, arg_min(state, event_id) AS state,
         arg_min(line_total, event_id) AS line_total, arg_max(updated, event_id) AS updated
  FROM stream GROUP BY user_id, day)
SELECT coalesce(b.user_id, s.user_id) AS user_id, coalesce(b.day, s.day) AS day,
       coalesce(b.event_id, s.event_id) AS event_id, coalesce(b.state, s.state) AS state,
       CAST(CASE WHEN s.n IS NULL THEN b.line_total WHEN b.user_id IS NOT NULL OR s.n > 1 THEN s.updated
                 ELSE s.line_total END AS DOUBLE) AS line_total
FROM base b FULL JOIN folded s ON b.user_id = s.user_id AND b.day = s.day""")
def stream_cdc_merge(t: Tables) -> DataFrame:
    landing, table = t.scratch("arrivals"), t.scratch("merged")
    split_into_batches(t.read("events"), 3, ["event_id"], landing, "parquet")
    schema = t.read("events").schema

    def keyed(events: DataFrame) -> DataFrame:
        return day_operations(order_events(events)).withColumn("day", F.date_format("event_time", "yyyy-MM-dd"))

    signups = latest_per_key(keyed(t.read("events")).where("state = 'signup'"), _MERGE_KEYS, _MERGE_SEQ)
    merge.start_table(signups, table, _MERGE_KEYS, _MERGE_SEQ)
    third = path_bytes(t.spark, landing) // 3 + 1  # a few micro-batches, whatever the size
    arrivals = keyed(read_stream(t.spark, landing, schema, fmt="parquet", max_bytes=third)).where("state <> 'signup'")
    finish(merge.stream_merge(arrivals, table, _MERGE_KEYS, _MERGE_SEQ, t.scratch("merge-checkpoint")))
    state = merge.merged_state(t.spark, table, _MERGE_KEYS, ["user_id", "day", "event_id", "state", "line_total"],
                               {"line_total": "updated_line_total"})
    return as_double(state)


@query("stream_table", f"""WITH {EVENTS} SELECT event_id, user_id, state, CAST(line_total AS DOUBLE) AS line_total FROM ev""")
def stream_table(t: Tables) -> DataFrame:
    """A stream appended to a named table, which is then read as a stream itself."""
    db = tables.database(t.spark, f"lakeops_{uuid.uuid4().hex[:12]}", t.scratch("db"))
    columns = ["event_id", "user_id", "state", "line_total"]
    finish(write_stream_table(t.event_stream().select(*columns), f"{db}.events", t.scratch("table-checkpoint")))
    return as_double(run(t, t.spark.readStream.table(f"{db}.events"), "from-table"))


@query("stream_clustered", f"""WITH {EVENTS} SELECT event_id, user_id, state, CAST(line_total AS DOUBLE) AS line_total FROM ev""")
def stream_clustered(t: Tables) -> DataFrame:
    path = t.scratch("clustered")
    rows = t.event_stream().select("event_id", "user_id", "state", "line_total")
    finish(write_stream_clustered(rows, path, ["state"], 8, t.scratch("clustered-checkpoint")))
    return as_double(t.spark.read.parquet(path).drop("_batch_id"))


# Late are some of the events that lie two hours and more before the latest.
_LATE = "event_id % 97 = 0"


@query("stream_late_rows", f"""WITH {EVENTS},
on_time AS (SELECT * FROM ev WHERE NOT ({_LATE} AND event_time < (SELECT max(event_time) FROM ev) - INTERVAL 2 HOUR)),
w AS (SELECT time_bucket(INTERVAL 1 HOUR, event_time) AS window_start, * FROM on_time)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, state, {_STATS}
FROM w GROUP BY window_start, state HAVING window_start + INTERVAL 1 HOUR <= (SELECT max(event_time) FROM on_time) - INTERVAL 10 MINUTE""")
def stream_late_rows(t: Tables) -> DataFrame:
    """Rows that come in a second batch, after the watermark of the first has passed them, are not counted; all others are."""
    landing, path, check = t.scratch("late"), t.scratch("late-out"), t.scratch("late-checkpoint")
    for batch in _in_time_and_late(t):
        batch.write.mode("append").parquet(landing)
        hourly = windows.tumbling(order_events(read_stream(t.spark, landing, batch.schema, fmt="parquet")), "event_time",
                                  "1 hour", ["state"], windows.order_stats("line_total"), DELAY)
        finish(write_stream(hourly, path, check))
    return _flat(t.spark.read.schema(hourly.schema).parquet(path))


def _in_time_and_late(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The events as a batch of those in time and a second one of the late ones: together all of them."""
    events = t.read("events")
    marked = events.join(F.broadcast(events.agg(F.max("ts").alias("latest")))).withColumn(
        "late", F.expr(f"{_LATE} AND ts < latest - INTERVAL 2 HOURS"))
    return marked.where("NOT late").drop("latest", "late"), marked.where("late").drop("latest", "late")


_EVENT_RULES = [Rule.check("positive", "line_total > 5"), Rule.check("known_state", "state <> 'error'")]


@query("stream_parts", f"""WITH {EVENTS},
dealt AS (
  SELECT *, CASE WHEN {_LATE} AND event_time < (SELECT max(event_time) FROM ev) - INTERVAL 2 HOUR THEN 'late'
                 WHEN NOT (line_total > 5) OR state = 'error' THEN 'quarantined' ELSE 'good' END AS part FROM ev)
SELECT part, event_id, state, CAST(line_total AS DOUBLE) AS line_total,
       (CASE WHEN NOT (line_total > 5) THEN 1 ELSE 0 END) + (CASE WHEN state = 'error' THEN 1 ELSE 0 END) AS broken FROM dealt""")
def stream_parts(t: Tables) -> DataFrame:
    """A stream dealt out into good, quarantined and late rows, which add up to its input."""
    landing, path, check = t.scratch("parts"), t.scratch("parts-out"), t.scratch("parts-checkpoint")
    for batch in _in_time_and_late(t):
        batch.write.mode("append").parquet(landing)
        stream = order_events(read_stream(t.spark, landing, batch.schema, fmt="parquet"))
        finish(write_stream_parts(stream, path, _EVENT_RULES, "event_time", "2 hours", check))
    parts = [part_of(t.spark, path, p, stream.schema).withColumn("part", F.lit(p)) for p in PARTS]
    return as_double(parts[0].unionByName(parts[1]).unionByName(parts[2]).select(
        "part", "event_id", "state", "line_total", F.size("violations").alias("broken")))


@query("stream_metrics", f"WITH {LOANS} " + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS expectation, count(*) FILTER (WHERE NOT {c}) AS failed FROM loans" for n, c in PASSED.items()))
def stream_metrics(t: Tables) -> DataFrame:
    """The failures that a stream keeps for each of its batches, summed."""
    path, landed = _landing(t)
    out, counts, check = t.scratch("observed"), t.scratch("observed-counts"), t.scratch("observed-checkpoint")
    some = path_bytes(t.spark, path) // 4 + 1  # a few micro-batches, whatever the size
    raw = read_stream(t.spark, path, landed.schema, fmt="parquet", max_bytes=some)
    finish(write_stream_observed(raw, out, counts, EXPECTATIONS, check, clean_loans))
    return observed_counts(t.spark, counts).select("expectation", "failed")
