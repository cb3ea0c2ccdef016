import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from lakeops.operators import cdc, joins, versions
from lakeops.operators.mutate import merge as batch_merge
from lakeops.operators.rules import Rule
from lakeops.plans.shaping import SILVER, risk
from lakeops.plans.summaries import by_grade, by_state
from lakeops.streaming import changes, medallion, merge, windows
from lakeops.streaming.io import (
    finish,
    ingest_new_files,
    read_stream,
    PARTS,
    observed_counts,
    part_of,
    write_stream,
    write_stream_batches,
    write_stream_clustered,
    write_stream_observed,
    write_stream_parts,
    write_stream_table,
)

EVENT = "event_id long, event_time timestamp, user_id long, state string, line_total decimal(12,2)"


def drop(spark, folder, name, data):
    """Land rows as one JSON file of a batch folder."""
    spark.createDataFrame(data, "event_id long, event_time string, user_id long, state string, line_total string") \
        .coalesce(1).write.json(f"{folder}/{name}")


def ev(i, at, user=1, state="NY", total="10.00"):
    return (i, f"2024-01-01 {at}", user, state, total)


def stream(spark, folder, max_files=1):
    from pyspark.sql.types import _parse_datatype_string
    return read_stream(spark, str(folder), _parse_datatype_string(EVENT), max_files)


def test_append_finds_sub_folders_and_restarts_without_repeats(spark, tmp_path):
    src, out, check = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "check")
    drop(spark, src, "batch_0", [ev(1, "10:00:00"), ev(2, "10:01:00")])
    drop(spark, src, "batch_1", [ev(3, "10:02:00")])
    query = finish(write_stream(stream(spark, src), out, check))
    assert spark.read.parquet(out).count() == 3
    assert len([p for p in query.recentProgress if p.numInputRows]) == 2  # one file per trigger
    drop(spark, src, "batch_2", [ev(4, "10:03:00")])
    finish(write_stream(stream(spark, src), out, check))
    assert rows(spark.read.parquet(out).select("event_id")) == [(1,), (2,), (3,), (4,)]
    finish(write_stream(stream(spark, src), out, check))
    assert spark.read.parquet(out).count() == 4


def test_processing_time_trigger(spark, tmp_path):
    drop(spark, tmp_path / "src", "batch_0", [ev(1, "10:00:00")])
    query = write_stream(stream(spark, tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "check"), "1 second")
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_table_sink_and_table_source(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS streamed_orders")
    drop(spark, tmp_path / "src", "b0", [ev(1, "10:00:00"), ev(2, "10:01:00")])
    finish(write_stream_table(stream(spark, tmp_path / "src"), "streamed_orders", str(tmp_path / "c1")))
    again = spark.readStream.table("streamed_orders")
    finish(write_stream(again, str(tmp_path / "out"), str(tmp_path / "c2")))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    spark.sql("DROP TABLE streamed_orders")


def test_ingest_takes_only_new_files(spark, tmp_path):
    src, dst, check = str(tmp_path / "src"), str(tmp_path / "dst"), str(tmp_path / "check")
    spark.range(10).write.mode("append").parquet(src)
    schema = spark.range(1).schema
    ingest_new_files(spark, src, dst, check, schema)
    spark.range(10, 15).write.mode("append").parquet(src)
    ingest_new_files(spark, src, dst, check, schema)
    ingest_new_files(spark, src, dst, check, schema)
    assert rows(spark.read.parquet(dst)) == sorted(((i,) for i in range(15)), key=lambda r: str(r[0]))


def test_rows_later_than_the_watermark_are_dropped(spark, tmp_path):
    src, out, check = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        hourly = windows.tumbling(stream(spark, src), "event_time", "1 minute", ["state"],
                                  windows.order_stats("line_total"), "10 minutes")
        return finish(write_stream(hourly, out, check))

    dropped = 0
    batches = [[ev(1, "10:00:10"), ev(2, "10:00:20", total="20.00")], [ev(3, "10:30:00")],
               [ev(4, "10:30:30")], [ev(5, "10:00:30"), ev(6, "10:25:00")], [ev(7, "11:30:00")], [ev(8, "11:30:10")]]
    for i, batch in enumerate(batches):
        drop(spark, src, f"b{i}", batch)
        query = run()
        dropped += sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    assert dropped == 1  # event 5; event 6 is late but within the ten minutes
    flat = windows.flatten_window(spark.read.parquet(out))
    got = {str(r.window_start)[11:16]: (r.order_count, float(r.avg_order_value), float(r.total_revenue))
           for r in flat.collect()}
    assert got == {"10:00": (2, 15.0, 30.0), "10:25": (1, 10.0, 10.0), "10:30": (2, 10.0, 20.0)}


def test_windows_agree_between_stream_and_batch_on_closed_windows(spark, tmp_path):
    data = [ev(i, f"10:{i:02d}:30", user=i % 3, state="NY" if i % 2 else "CA", total=f"{i}.25") for i in range(40)]
    drop(spark, tmp_path / "src", "b0", data)
    batch = spark.createDataFrame(data, "event_id long, event_time string, user_id long, state string, line_total string") \
        .withColumns({"event_time": F.to_timestamp("event_time"), "line_total": F.col("line_total").cast("decimal(12,2)")})
    for name, build in {
        "tumbling": lambda d, w: windows.tumbling(d, "event_time", "5 minutes", ["state"], windows.order_stats("line_total"), w),
        "sliding": lambda d, w: windows.sliding(d, "event_time", "5 minutes", "1 minute", ["state"], windows.order_stats("line_total"), w),
        "sessions": lambda d, w: windows.sessions(d, "event_time", "3 minutes", ["user_id"], windows.order_stats("line_total"), w),
    }.items():
        out = str(tmp_path / name)
        live = build(stream(spark, tmp_path / "src"), "2 minutes")
        finish(write_stream(live, out, out + "-check"))
        closed = build(batch, None).where(F.col("window.end") <= F.lit("2024-01-01 10:37:30").cast("timestamp"))
        assert rows(spark.read.schema(live.schema).parquet(out)) == rows(closed), name


def test_events_exactly_one_gap_apart_are_one_session(spark):
    df = spark.createDataFrame([("a", "2024-01-01 10:00:00"), ("a", "2024-01-01 10:30:00"),
                                ("a", "2024-01-01 11:00:00.000001")], "k string, ts string") \
        .withColumn("ts", F.to_timestamp("ts"))
    out = windows.sessions(df, "ts", "30 minutes", ["k"], [F.count("*").alias("n")])
    assert rows(out.select("n")) == [(1,), (2,)]


def brute_pairs(left, right, before, after):
    return sorted((a[0], b[0]) for a in left for b in right
                  if a[1] == b[1] and a[2] - before <= b[2] <= a[2] + after)


@pytest.mark.parametrize("splits", [1, 4])
def test_interval_join_against_brute_force(spark, splits):
    import random
    rng = random.Random(3)
    left = [(i, 0 if rng.random() < 0.4 else rng.randint(1, 5), rng.randint(0, 6000)) for i in range(400)]
    right = [(i, 0 if rng.random() < 0.4 else rng.randint(1, 5), rng.randint(0, 6000)) for i in range(300)]
    right += [(900, 0, left[0][2] - 300), (901, 0, left[0][2] + 120)]
    a = spark.createDataFrame(left, "lid int, k int, s long").select("lid", "k", F.timestamp_seconds("s").alias("ts"))
    b = spark.createDataFrame(right, "rid int, k int, s long").select("rid", "k", F.timestamp_seconds("s").alias("ts"))
    got = sorted((r.lid, r.rid) for r in joins.interval_join(a, b, ["k"], "ts", 300, 120, splits).collect())
    assert got == brute_pairs(left, right, 300, 120)


def test_stream_interval_join_over_batches(spark, tmp_path):
    def side(folder, name, data):
        drop(spark, tmp_path / folder, name, data)

    side("orders", "b0", [ev(1, "10:00:00"), ev(2, "10:20:00", user=2)])
    side("orders", "b1", [ev(3, "10:40:00")])
    side("reviews", "b0", [ev(11, "10:04:59"), ev(12, "10:05:01"), ev(13, "10:20:00", user=9)])
    side("reviews", "b1", [ev(14, "10:35:00"), ev(15, "10:45:00"), ev(16, "10:45:01")])
    a = stream(spark, tmp_path / "orders").select("user_id", "event_time", F.col("event_id").alias("order_id"))
    b = stream(spark, tmp_path / "reviews").select("user_id", "event_time", F.col("event_id").alias("review_id"))
    pairs = joins.interval_join(a.withWatermark("event_time", "10 minutes"), b.withWatermark("event_time", "10 minutes"),
                                ["user_id"], "event_time", 300, 300, splits=2)
    finish(write_stream(pairs, str(tmp_path / "out"), str(tmp_path / "check")))
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("order_id", "review_id")) == [(1, 11), (3, 14), (3, 15)]


def test_stream_merge_equals_batch_merge_and_survives_replay(spark, tmp_path):
    src, table = tmp_path / "src", str(tmp_path / "table")
    keys, seq = ["user_id"], ["event_time", "event_id"]
    columns, set_ = ["user_id", "state", "line_total"], {"line_total": "updated"}

    def with_update(df):
        return df.withColumn("updated", (F.col("line_total") * 2).cast("decimal(12,2)"))

    base = with_update(spark.createDataFrame([ev(0, "09:00:00", user=1, total="5.00")],
                                             "event_id long, event_time string, user_id long, state string, line_total string")
                       .withColumns({"event_time": F.to_timestamp("event_time"),
                                     "line_total": F.col("line_total").cast("decimal(12,2)")}))
    merge.start_table(base, table, keys, seq)
    drop(spark, src, "b0", [ev(1, "10:00:00", user=1, total="10.00"), ev(2, "10:00:00", user=2, total="20.00", state="CA")])
    drop(spark, src, "b1", [ev(3, "10:05:00", user=2, total="21.00"), ev(4, "10:05:00", user=3, total="30.00")])

    def run(check):
        finish(merge.stream_merge(with_update(stream(spark, src)), table, keys, seq, str(tmp_path / check)))
        return rows(merge.merged_state(spark, table, keys, columns, set_).withColumn("line_total", F.col("line_total").cast("double")))

    want = [(1, "NY", 20.0), (2, "CA", 42.0), (3, "NY", 30.0)]
    assert run("check") == want
    assert run("check-lost") == want  # all batches again under the same ids: nothing doubles

    # The same by merging batch after batch.
    target = base.select("user_id", "state", "line_total")
    for b in ("b0", "b1"):
        batch = with_update(spark.read.schema(EVENT).json(f"{src}/{b}"))
        target = batch_merge(target, batch, keys, {"line_total": "source.updated"})
    assert rows(target.withColumn("line_total", F.col("line_total").cast("double"))) == want

    merge.compact_merged(spark, table, str(tmp_path / "compacted"), keys)
    table = str(tmp_path / "compacted")
    assert rows(merge.merged_state(spark, table, keys, columns, set_)
                .withColumn("line_total", F.col("line_total").cast("double"))) == want
    assert run("check-after-compaction") == want  # batches folded into the base come again: an insert stays an insert


def test_foreach_batch_gets_every_row_once(spark, tmp_path):
    drop(spark, tmp_path / "src", "b0", [ev(1, "10:00:00")])
    drop(spark, tmp_path / "src", "b1", [ev(2, "10:00:00"), ev(3, "10:00:00")])
    seen = {}
    finish(write_stream_batches(stream(spark, tmp_path / "src"),
                                lambda df, i: seen.__setitem__(i, df.count()), str(tmp_path / "check")))
    assert sorted(seen.values()) == [1, 2] and sorted(seen) == [0, 1]


def test_clustered_stream_write(spark, tmp_path):
    data = [ev(i, "10:00:00", user=i % 50, state="ABCDEFGH"[i % 8]) for i in range(400)]
    drop(spark, tmp_path / "src", "b0", data)
    out = str(tmp_path / "out")
    finish(write_stream_clustered(stream(spark, tmp_path / "src"), out, ["state"], 8, str(tmp_path / "check")))
    back = spark.read.parquet(out)
    assert back.count() == 400
    touched = back.where("state = 'C'").select(F.col("_metadata.file_path")).distinct().count()
    assert touched <= 2


RULES = {"valid_loan_amount": ("loan_amnt > 0 AND loan_amnt < 1000000", "drop"),
         "valid_state": ("addr_state IS NOT NULL", "drop"),
         "reasonable_interest_rate": ("int_rate BETWEEN 0 AND 50", "warn")}
LOAN = "loan_id long, loan_amnt double, funded_amnt double, term string, int_rate double, grade string, addr_state string, dti double"


def loan(i, amount=1000.0, rate=10.0, grade="A", state="CA"):
    return (i, amount, amount, "36 months", rate, grade, state, 1.5)


def clean(loans):
    return medallion.renamed(loans, SILVER).withColumn("risk_category", risk("loan_grade", ("A", "B"), ("C", "D")))


GOLD = {"by_state": by_state, "by_grade": by_grade}


def test_medallion_runs_twice_and_counts_failures(spark, tmp_path):
    src, root = str(tmp_path / "src"), str(tmp_path / "root")
    spark.createDataFrame([loan(1), loan(2, 3000.0, grade="C"), loan(3, -5.0), loan(4, state=None), loan(5, rate=99.0, grade="G")],
                          LOAN).write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    gold, query = medallion.run_medallion(spark, src, root, schema, RULES, clean, GOLD)
    first = gold["by_state"]
    assert rows(first.select("state", "total_loans", F.col("total_loan_amount").cast("int"))) == [("CA", 3, 5000)]
    metrics = [p.observedMetrics[medallion.SILVER_METRICS] for p in query.recentProgress
               if medallion.SILVER_METRICS in p.observedMetrics]
    assert sum(m.valid_loan_amount for m in metrics) == 1
    assert sum(m.reasonable_interest_rate for m in metrics) == 1
    silver = spark.read.parquet(f"{root}/silver")
    assert rows(silver.select("loan_id", "risk_category")) == [(1, "Low"), (2, "Medium"), (5, "High")]
    assert silver.schema["loan_amount"].dataType.simpleString() == "decimal(10,2)"

    spark.createDataFrame([loan(6, state="NY")], LOAN).write.mode("append").parquet(src)
    gold, _ = medallion.run_medallion(spark, src, root, schema, RULES, clean, GOLD)
    assert rows(first.select("total_loans")) == [(3,)]  # earlier reports stay
    assert rows(gold["by_state"].select("state", "total_loans")) == [("CA", 3), ("NY", 1)]
    gold, _ = medallion.run_medallion(spark, src, root, schema, RULES, clean, GOLD)
    assert rows(gold["by_grade"].select("loan_grade", "total_loans")) == [("A", 2), ("C", 1), ("G", 1)]


def test_failing_expectation_stops_the_stream(spark, tmp_path):
    drop(spark, tmp_path / "src", "b0", [ev(1, "10:00:00", total="-1.00")])
    from lakeops.operators.rules import expect
    checked = expect(stream(spark, tmp_path / "src"), {"positive": ("line_total > 0", "fail")})
    with pytest.raises(PySparkException, match="expectation failed: positive"):
        finish(write_stream(checked, str(tmp_path / "out"), str(tmp_path / "check")))


def land(spark, folder, name, data):
    spark.createDataFrame(data, EVENT.replace("timestamp", "string").replace("decimal(12,2)", "string")).withColumn(
        "event_time", F.col("event_time").cast("timestamp")).withColumn("line_total", F.col("line_total").cast("decimal(12,2)")).coalesce(1) \
        .write.parquet(f"{folder}/{name}")


def parquet_stream(spark, folder, max_files=None):
    from pyspark.sql.types import _parse_datatype_string
    return read_stream(spark, str(folder), _parse_datatype_string(EVENT), max_files, fmt="parquet")


def test_counts_outlast_what_the_progress_remembers(spark, tmp_path):
    """More batches than a query's progress holds, in two runs."""
    src, out, counts, check = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "counts"), str(tmp_path / "check")
    rules = {"positive": ("line_total > 0", "drop"), "known": "state IS NOT NULL"}
    total = 0
    for run in range(2):
        rows_ = [ev(i, "10:00:00", state=None if i % 3 == 0 else "NY", total="0.00" if i % 5 == 0 else "1.00") for i in range(total, total + 55)]
        df = spark.createDataFrame(rows_, "event_id long, event_time string, user_id long, state string, line_total string").selectExpr(
            "event_id", "cast(event_time AS timestamp) AS event_time", "user_id", "state", "cast(line_total AS decimal(12,2)) AS line_total")
        df.repartition(55, "event_id").write.option("maxRecordsPerFile", 1).mode("append").parquet(str(src))
        total += 55
        finish(write_stream_observed(parquet_stream(spark, src, 1), out, counts, rules, check))
    assert spark.read.parquet(counts).select("_batch_id").distinct().count() > 100
    got = {r.expectation: (r.failed, r.records) for r in observed_counts(spark, counts).collect()}
    assert got == {"positive": (22, 110), "known": (37, 110)}
    assert spark.read.parquet(out).count() == 88


def test_parts_of_a_batch_add_up_also_when_it_is_repeated(spark, tmp_path):
    src, out, check = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "check")
    rules = [Rule.check("positive", "line_total > 0")]
    land(spark, src, "a", [ev(1, "12:00:00"), ev(2, "09:00:00"), ev(3, "11:00:00", total="0.00")])
    schema = parquet_stream(spark, src).schema
    run = lambda at: finish(write_stream_parts(parquet_stream(spark, src), out, rules, "event_time", "1 hour", at))
    run(check)
    land(spark, src, "b", [ev(4, "10:30:00"), ev(5, "11:00:00"), ev(6, "10:00:00", total="0.00"), ev(7, "13:00:00", total="0.00")])
    spark.createDataFrame([(8, None, 1, "NY", None)], schema).write.parquet(f"{src}/c")
    run(check)

    def ids():
        return {p: [r[0] for r in rows(part_of(spark, out, p, schema).select("event_id"))] for p in PARTS}

    # Row 2 came in the first batch, before any watermark; a row without a time isn't late.
    want = {"good": [1, 2, 5, 8], "quarantined": [3, 7], "late": [4, 6]}
    assert ids() == want
    # The second batch again, as after a failure: its entry is taken from the list of those that are done.
    (tmp_path / "check" / "commits" / "1").unlink()
    (tmp_path / "check" / "commits" / ".1.crc").unlink(missing_ok=True)
    run(check)
    assert ids() == want


def test_the_change_feed_is_applied_once(spark, tmp_path):
    log, kept, check = str(tmp_path / "log"), str(tmp_path / "kept"), str(tmp_path / "check")
    kind = "id int, v string"
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], kind)
    steps = {0: [(9, "old", "insert")], 1: [(1, "a", "update_preimage"), (1, "A", "update_postimage"), (4, "d", "insert")],
             2: [(4, "d", "delete"), (None, "n", "delete")], 3: [(4, "D", "insert"), (2, "b", "delete")]}

    def put(version):
        versions.commit(log, spark.createDataFrame(steps[version], kind + ", _change_type string"), version, f"2024-01-0{version + 1}")

    def run():
        schema = versions.read_log(spark, log).schema
        finish(changes.stream_apply(changes.stream_changes(spark, log, schema, from_version=1), kept, ["id"], check))
        return rows(changes.applied(spark, target, kept, ["id"]))

    for v in (0, 1, 2):
        put(v)
    assert run() == rows(spark.createDataFrame([(1, "A"), (2, "b"), (3, "c")], kind))
    put(3)
    put(1)  # a commit that is repeated is read again, and changes nothing
    want = rows(spark.createDataFrame([(1, "A"), (3, "c"), (4, "D")], kind))
    assert run() == want and run() == want


def test_a_history_stream_survives_a_repeated_batch(spark, tmp_path):
    src, out, check = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "check")
    how = (["user_id"], ["event_time", "event_id"], ["state"], "state = 'error'")
    every = [[ev(1, "10:00:00"), ev(2, "10:30:00", state="CA"), ev(3, "11:00:00", user=2)],
             [ev(4, "10:10:00", state="error"), ev(5, "10:20:00"), ev(6, "09:00:00", user=2, state="CA")]]
    for k, data in enumerate(every):
        land(spark, src, f"b{k}", data)
        finish(merge.stream_scd2(parquet_stream(spark, src), out, *how, check))
    feed = spark.read.schema(parquet_stream(spark, src).schema).parquet(f"{src}/*")
    want = rows(cdc.scd2(feed, *how))
    history = lambda: rows(cdc.scd2_history(merge.scd2_stored(spark, out, *how[:2]), *how[:3]))
    assert history() == want
    (tmp_path / "check" / "commits" / "1").unlink()
    (tmp_path / "check" / "commits" / ".1.crc").unlink(missing_ok=True)
    finish(merge.stream_scd2(parquet_stream(spark, src), out, *how, check))
    assert history() == want
