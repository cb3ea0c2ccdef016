import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from lakeops.operators import cdc, mutate, versions
from lakeops.operators.versions import VersionNotAvailable

COLS = "order_number long, state string, segment string, total double"
KEYS = ["order_number", "state"]


def table(spark, *data, schema=COLS):
    return spark.createDataFrame(list(data), schema)


def base(spark):
    return table(spark, (1, "NY", "Gold", 10.0), (2, "CA", "Silver", 20.0), (3, None, "Gold", 30.0))


def test_update_sees_old_values_and_skips_null_conditions(spark):
    out = mutate.update_where(base(spark), {"total": "total * 2", "segment": "CASE WHEN total > 10 THEN 'x' ELSE 'y' END"},
                              "state IN ('NY', 'CA')")
    assert rows(out) == [(1, "NY", "y", 20.0), (2, "CA", "x", 40.0), (3, None, "Gold", 30.0)]


def test_delete_keeps_rows_of_null_condition(spark):
    assert rows(mutate.delete_where(base(spark), "state = 'NY'").select("order_number")) == [(2,), (3,)]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_merge_updates_inserts_and_never_matches_null_keys(spark, limit):
    source = table(spark, (1, "NY", "Platinum", 11.0), (3, None, "Bronze", 33.0), (5, "WA", "Gold", 50.0))
    out = mutate.merge(base(spark), source, KEYS, {"total": "source.total"}, broadcast_bytes=limit)
    assert rows(out) == [(1, "NY", "Gold", 11.0), (2, "CA", "Silver", 20.0), (3, None, "Bronze", 33.0),
                         (3, None, "Gold", 30.0), (5, "WA", "Gold", 50.0)]
    again = mutate.merge(out.where("state IS NOT NULL"), source.where("state IS NOT NULL"), KEYS,
                         {"total": "source.total"}, broadcast_bytes=limit)
    assert rows(again) == rows(out.where("state IS NOT NULL"))


def test_merge_delete_and_no_insert(spark):
    source = table(spark, (1, "NY", "gone", 0.0), (2, "CA", "Gold", 21.0), (9, "WA", "Gold", 50.0))
    out = mutate.merge(base(spark), source, KEYS, delete_when="source.segment = 'gone'", insert=False)
    assert rows(out) == [(2, "CA", "Gold", 21.0), (3, None, "Gold", 30.0)]


def test_merge_raises_when_two_source_rows_match_one_target_row(spark):
    twice = table(spark, (1, "NY", "a", 1.0), (1, "NY", "b", 2.0))
    with pytest.raises(PySparkException, match="several source rows"):
        mutate.merge(base(spark), twice, KEYS).collect()


def test_merge_inserts_unmatched_copies(spark):
    twice = table(spark, (8, "NY", "a", 1.0), (8, "NY", "b", 2.0))
    assert mutate.merge(base(spark), twice, KEYS).count() == 5


def test_merge_does_not_shuffle_the_target_for_a_small_source(spark):
    target = spark.range(100_000).select("id", (F.col("id") * 2.0).alias("v"))
    source = spark.range(50).select("id", F.lit(0.0).alias("v"))
    plan = mutate.merge(target, source, ["id"], insert=False)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_latest_per_key(spark):
    df = table(spark, ("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, None), schema="k string, seq int, v string")
    assert rows(mutate.latest_per_key(df, ["k"], ["seq"])) == [("a", 3, "z"), ("b", 1, None)]


def test_change_counts_and_feed_round_trip(spark):
    before = base(spark)
    after = table(spark, (1, "NY", "Gold", 10.0), (2, "CA", "Silver", 25.0), (7, "OR", None, 70.0))
    assert tuple(mutate.change_counts(before, after, ["order_number"]).first()) == (3, 3, 1, 1, 1)
    feed = cdc.change_feed(before, after, ["order_number"])
    assert rows(feed.groupBy("_change_type").count()) == [
        ("delete", 1), ("insert", 1), ("update_postimage", 1), ("update_preimage", 1)]
    stamped = versions.stamp(feed, 1, "2024-01-01")
    assert rows(cdc.apply_changes(before, stamped, ["order_number"])) == rows(after)


def test_diff_of_snapshots(spark):
    after = table(spark, (1, "NY", "Gold", 10.0), (2, "CA", None, 25.0), (7, "OR", None, 70.0))
    out = mutate.diff(base(spark), after, ["order_number"])
    assert rows(out.select("order_number", "change", F.array_join("columns", ","))) == [
        (2, "changed", "segment,total"), (3, "removed", None), (7, "added", None)]


def test_pairing_raises_on_a_repeated_key(spark):
    twice = base(spark).unionByName(base(spark))
    with pytest.raises(PySparkException, match="not unique"):
        mutate.change_counts(base(spark), twice, ["order_number"]).collect()


@pytest.fixture
def log(spark, tmp_path):
    """Three inserts, two updates, one delete, each a commit."""
    path = str(tmp_path / "log")
    new = table(spark, (999010, "WA", "Gold", 120.0), (999011, "OR", "Silver", 80.0), (999012, "CA", "Gold", 60.0))
    key = ["order_number"]

    def now(v):
        return versions.as_of_version(versions.read_log(spark, path), key, v)

    versions.commit(path, cdc.insert_changes(base(spark)), 0, "2024-01-01")
    versions.commit(path, cdc.insert_changes(new), 1, "2024-01-02")
    versions.commit(path, cdc.update_changes(now(1), {"total": "total * 1.1"}, "order_number IN (999010, 999011)"),
                    2, "2024-01-03")
    versions.commit(path, cdc.delete_changes(now(2), "order_number = 999012"), 3, "2024-01-04")
    return versions.read_log(spark, path), path


def test_feed_of_the_standard_workload(spark, log):
    changes = cdc.read_changes(log[0], from_version=1)
    assert changes.count() == 8
    assert rows(cdc.changes_by_type(changes)) == [
        ("delete", 1), ("insert", 3), ("update_postimage", 2), ("update_preimage", 2)]
    assert changes.where("_change_type LIKE 'update%'").count() == 4
    assert rows(versions.version_counts(log[0])) == [(0, 3), (1, 6), (2, 6), (3, 5)]
    assert [r.operation for r in versions.history(log[0]).collect()] == [
        "DELETE", "UPDATE", "WRITE", "WRITE"]


def test_repeating_a_commit_changes_nothing(spark, log):
    df, path = log
    assert df.count() == 11
    again = df.where("_commit_version = 3").drop("_commit_version", "_commit_timestamp").collect()
    versions.commit(path, spark.createDataFrame(again, df.drop("_commit_version", "_commit_timestamp").schema),
                    3, "2024-01-04")
    assert versions.read_log(spark, path).count() == 11


def test_an_empty_commit_replaces_the_rows_of_its_version_and_is_listed(spark, log):
    df, path = log
    nothing = df.drop("_commit_version", "_commit_timestamp").limit(0)
    versions.commit(path, nothing, 3, "2024-01-04")
    versions.commit(path, nothing, 4, "2024-01-05")
    after, commits = versions.read_log(spark, path), versions.commits(spark, path)
    assert after.where("_commit_version = 3").count() == 0 and after.count() == 10
    assert [(r.version, r.operation) for r in versions.history(after, commits).collect()] == [
        (4, "EMPTY"), (3, "EMPTY"), (2, "UPDATE"), (1, "WRITE"), (0, "WRITE")]
    key = ["order_number"]
    assert versions.version_at(commits, "2024-01-05 12:00:00") == 4
    late = versions.as_of_timestamp(after, key, "2024-01-03 12:00:00", commits)
    assert rows(late) == rows(versions.as_of_version(after, key, 2))
    with pytest.raises(VersionNotAvailable):
        versions.as_of_timestamp(after, key, "2023-12-31", commits)


def test_applying_a_feed_gives_the_other_snapshot_with_null_keys(spark):
    a = spark.createDataFrame([(None, "a"), (1, "a"), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(None, "A"), (1, "b"), (3, "y")], "k int, v string")
    feed = cdc.change_feed(a, b, ["k"]).withColumn("_commit_version", F.lit(1))
    for limit in (0, 1 << 20):
        assert rows(cdc.apply_changes(a, feed, ["k"], broadcast_bytes=limit)) == rows(b)


def test_pairing_snapshots_of_different_columns_raises(spark):
    a = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError, match="columns"):
        mutate.diff(a, a.withColumn("more", F.lit(1)), ["k"])


def test_a_merge_reads_each_side_once_or_leaves_the_target_unshuffled(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("target", "source")]
    for p in paths:
        base(spark).write.parquet(p)
    target, source = (spark.read.parquet(p) for p in paths)

    def plan(limit):
        out = mutate.merge(target, source, ["order_number"], {"total": "source.total"}, broadcast_bytes=limit)
        return out._jdf.queryExecution().executedPlan().toString()

    shuffled = plan(0)
    assert shuffled.count("FileScan") == 2 and "FullOuter" in shuffled
    small = plan(1 << 20)
    assert "FullOuter" not in small and "SortMergeJoin" not in small


def test_broadcast_limit_counts_bytes(spark):
    from lakeops.operators.skew import broadcast_if_small
    wide = spark.range(4).withColumn("t", F.repeat(F.lit("x"), 1000))
    assert broadcast_if_small(wide, 3000) is wide and broadcast_if_small(wide, 6000) is not wide


@pytest.mark.parametrize("seed", [3, 4])
def test_scd_by_batches_is_a_full_run(spark, seed):
    import random
    rng = random.Random(seed)
    events = [(rng.choice([1, 1, 1, 2, 3, None]), i, rng.choice("ab"), rng.choice(["U", "U", "U", "D"])) for i in range(60)]
    rng.shuffle(events)
    kind = "k int, seq int, v string, op string"
    feed, (first, second) = spark.createDataFrame(events, kind), (spark.createDataFrame(x, kind) for x in (events[:40], events[40:]))
    how = {"keys": ["k"], "seq": ["seq"], "columns": ["v"], "delete_when": "op = 'D'"}
    state = cdc.scd2_apply(cdc.scd2_state(first, **how), second, **how)
    assert rows(cdc.scd2_history(state, ["k"], ["seq"], ["v"])) == rows(cdc.scd2(feed, **how))
    state = cdc.scd1_apply(cdc.scd1_state(first, ["k"], ["seq"]), second, ["k"], ["seq"])
    assert rows(state.where("op <> 'D'")) == rows(cdc.scd1(feed, ["k"], ["seq"], "op = 'D'"))


def test_time_travel_by_version_and_time(spark, log):
    key = ["order_number"]
    for version, n in enumerate([3, 6, 6, 5]):
        by_version = versions.as_of_version(log[0], key, version)
        by_time = versions.as_of_timestamp(log[0], key, f"2024-01-0{version + 1} 23:00:00")
        assert by_version.count() == n and rows(by_version) == rows(by_time)
    with pytest.raises(VersionNotAvailable):
        versions.as_of_timestamp(log[0], key, "2023-12-31")


def test_restore_keeps_history(spark, log):
    df, path = log
    key = ["order_number"]
    changes = versions.restore(df, key, 0, 4, "2024-01-05")
    versions.commit(path, changes.drop("_commit_version", "_commit_timestamp"), 4, "2024-01-05")
    after = versions.read_log(spark, path)
    assert rows(versions.as_of_version(after, key, 4)) == rows(base(spark))
    assert versions.as_of_version(after, key, 3).count() == 5
    assert versions.history(after).count() == 5


def test_compacted_log_serves_from_the_cut_off_on(spark, log):
    key = ["order_number"]
    small = versions.compact_log(log[0], key, cutoff=2)
    assert small.count() == 7 < log[0].count()
    for version in (2, 3):
        assert rows(versions.as_of_version(small, key, version)) == rows(versions.as_of_version(log[0], key, version))
    with pytest.raises(VersionNotAvailable):
        versions.as_of_version(small, key, 1)
    with pytest.raises(VersionNotAvailable):
        versions.as_of_timestamp(small, key, "2024-01-02 12:00:00")


def test_clones(spark, log, tmp_path):
    key = ["order_number"]
    deep = versions.clone(log[0], key, str(tmp_path / "copy"), 1)
    view = versions.clone_view(log[0], key, "clone_v1", 1)
    assert rows(deep) == rows(view) and deep.count() == 6
    with pytest.raises(Exception):
        versions.clone(log[0], key, str(tmp_path / "copy"), 1)  # a clone never overwrites


def test_diff_names_changed_columns(spark, log):
    out = rows(versions.diff_versions(log[0], ["order_number"], 1, 3).select(
        "order_number", "change", F.array_join("columns", ",")))
    assert out == [(999010, "changed", "total"), (999011, "changed", "total"), (999012, "removed", None)]


def test_version_filter_prunes_folders(spark, log):
    plan = cdc.read_changes(log[0], from_version=2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_commit_version" in plan


def test_audit_log(spark, log):
    out = cdc.audit_log(log[0], ["order_number"])
    assert out.columns == ["order_number", "_change_type", "_commit_timestamp", "changed_by"]
    assert out.where("changed_by IS NULL").count() == 0


FEED = "k int, seq int, id int, v string, op string"


def brute_scd2(feed):
    out = []
    for k in {r[0] for r in feed}:
        kept, prev = [], None
        for r in sorted((r for r in set(feed) if r[0] == k), key=lambda r: (r[1], r[2])):
            state = (True, None) if r[4] == "D" else (False, r[3])
            if state != prev:
                kept.append((r[1], state))
            prev = state
        for i, (start, (gone, v)) in enumerate(kept):
            if not gone:
                end = kept[i + 1][0] if i + 1 < len(kept) else None
                out.append((k, v, start, end, end is None))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [10_000, 25])
def test_scd2_against_brute_force_with_a_hot_key(spark, limit):
    rng = random.Random(7)
    feed = []
    for i in range(600):
        k = 0 if rng.random() < 0.4 else rng.randint(1, 20)  # key 0 holds over a third of all rows
        feed.append((k, rng.randint(0, 200), i, rng.choice([None, "a", "b"]), rng.choice(["U", "U", "U", "D"])))
    feed += feed[:150]  # replayed rows
    df = spark.createDataFrame(feed, FEED).repartition(5)
    out = cdc.scd2(df, ["k"], ["seq", "id"], ["v"], "op = 'D'", max_group_rows=limit)
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute_scd2(feed)


def test_scd2_current_rows_are_scd1(spark):
    feed = [(1, 1, 1, "a", "I"), (1, 3, 3, "c", "U"), (1, 2, 2, "b", "U"), (2, 1, 4, "x", "I"), (2, 5, 5, "x", "D"),
            (3, 1, 6, "m", "I"), (3, 2, 7, "m", "D"), (3, 3, 8, "m", "I")]
    df = spark.createDataFrame(feed, FEED)
    two = cdc.scd2(df, ["k"], ["seq", "id"], ["v"], "op = 'D'")
    one = cdc.scd1(df, ["k"], ["seq", "id"], "op = 'D'")
    assert rows(two.where("_is_current").select("k", "v")) == rows(one.select("k", "v")) == [(1, "c"), (3, "m")]
    assert rows(two.where("k = 3").select("v", "_start_at", "_end_at")) == [("m", 1, 2), ("m", 3, None)]


@pytest.mark.parametrize("seed,limit", [(1, 5_000_000), (2, 5_000_000), (3, 4)])
def test_late_rows_splice_into_the_history(spark, seed, limit):
    """Batch after batch in random order, with repeats of known rows; each state equals a full run over what has come so far."""
    rng = random.Random(seed)
    events = [(rng.choice([1, 1, 1, 1, 2, None]), i, -i, rng.choice(["a", "a", "b", None]), rng.choice(["U", "U", "U", "D"])) for i in range(50)]
    rng.shuffle(events)
    kind = "k int, seq int, id int, v string, op string"
    how = {"keys": ["k"], "seq": ["seq", "id"], "columns": ["v"], "delete_when": "op = 'D'", "max_group_rows": limit}
    state = cdc.scd2_state(spark.createDataFrame(events[:20], kind), **how)
    for a, b in ((20, 23), (23, 24), (24, 40), (40, 50)):
        known = rng.sample(events[:a], 3)
        state = mutate.kept_still(cdc.scd2_apply(state, spark.createDataFrame(events[a:b] + known, kind), **how))
        want = cdc.scd2(spark.createDataFrame(events[:b], kind), **how)
        assert rows(cdc.scd2_history(state, ["k"], ["seq", "id"], ["v"])) == rows(want)
    assert state.count() == 50
    assert cdc.scd2_splice(state, spark.createDataFrame(events[:30], kind), **how).count() == 0


@pytest.mark.parametrize("limit", [10**6, 3])
def test_splices_shuffle_what_they_read_once(spark, limit):
    """Batch and state are joined once, whatever the later steps are: these read the rows that were kept."""
    how = {"keys": ["k"], "seq": ["seq"], "columns": ["v"], "delete_when": "op = 'D'", "max_group_rows": limit}
    kind = "k int, seq int, v string, op string"
    feed = [(i % 5 or None, i * 7919 % 1009, "ab"[i * i % 7 % 2], "D" if i % 11 == 0 else "U") for i in range(120)]
    state = mutate.kept_still(cdc.scd2_state(spark.createDataFrame(feed[:60], kind), **how))
    changed = cdc.scd2_splice(state, spark.createDataFrame(feed[50:], kind), **how)
    if limit > 120:
        plan = changed._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1 and "Join" not in plan and "Aggregate" not in plan
    state = cdc.scd2_apply(state, spark.createDataFrame(feed[50:], kind), **how)
    assert rows(cdc.scd2_history(state, ["k"], ["seq"], ["v"])) == rows(cdc.scd2(spark.createDataFrame(feed, kind), **how))


def test_a_late_row_changes_its_neighbours_only(spark):
    kind = "k int, seq int, v string, op string"
    how = {"keys": ["k"], "seq": ["seq"], "columns": ["v"], "delete_when": "op = 'D'"}
    feed = [(k, s, "a" if s % 100 < 50 else "b", "U") for k in range(3) for s in range(0, 1000, 10)]
    state = mutate.kept_still(cdc.scd2_state(spark.createDataFrame(feed, kind), **how))
    # Within a stretch: the stretch ends earlier, the row opens one, the next repeat opens another.
    changed = cdc.scd2_splice(state, spark.createDataFrame([(1, 525, "c", "U")], kind), **how)
    assert rows(changed.select("k", "seq", "_opens", "_end_at")) == [(1, 500, True, 525), (1, 525, True, 530), (1, 530, True, 550)]
    # The same value: nothing but the row itself.
    changed = cdc.scd2_splice(state, spark.createDataFrame([(1, 525, "a", "U")], kind), **how)
    assert rows(changed.select("k", "seq", "_opens", "_end_at")) == [(1, 525, False, None)]
