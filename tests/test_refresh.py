import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from lakeops.operators import cdc, layout, mutate
from lakeops.operators.refresh import Kept
from lakeops.operators.skew import broadcast_if_small

KIND = "id int, g string, v int, w string"


def changed(rng, state):
    """A later state: some rows go, some change, some come."""
    out = {k: r for k, r in state.items() if rng.random() > 0.2}
    for k in rng.sample(sorted(out), len(out) // 4):
        out[k] = (rng.choice("abcd"), rng.choice([None, *range(8)]), rng.choice("xyz"))
    for _ in range(rng.randrange(12)):
        out[len(out) + rng.randrange(100, 10**6)] = (rng.choice(["a", "e", None]), rng.randrange(20), rng.choice(["x", None]))
    return out


@pytest.mark.parametrize("seed,limit", [(1, 1 << 20), (2, 0)])
def test_kept_aggregates_equal_recomputed_ones(spark, seed, limit):
    rng = random.Random(seed)
    kept = Kept(["g"], sums=["v"], extremes=["v"], distinct="w")
    state = {k: (rng.choice(["a", "b", "c", None]), rng.choice([None, *range(10)]), rng.choice("xyz")) for k in range(40)}
    frame = lambda s: spark.createDataFrame([(k, *r) for k, r in s.items()], KIND)
    groups, values = kept.groups(frame(state)), kept.values(frame(state))
    for _ in range(4):
        later = changed(rng, state)
        feed = cdc.change_feed(frame(state), frame(later), ["id"])
        groups, values = kept.refreshed(groups, values, feed, frame(later), broadcast_bytes=limit)
        groups, values = mutate.kept_still(groups), mutate.kept_still(values)
        assert rows(groups) == rows(kept.groups(frame(later)).select(*groups.columns))
        assert rows(values) == rows(kept.values(frame(later)))
        state = later


def test_only_groups_that_lost_an_extreme_are_read(spark):
    kept = Kept(["g"], extremes=["v"])
    before = spark.createDataFrame([(1, "a", 1, ""), (2, "a", 5, ""), (3, "b", 1, ""), (4, "b", 2, ""), (5, "c", 7, "")], KIND)
    after = spark.createDataFrame([(1, "a", 1, ""), (2, "a", 9, ""), (4, "b", 2, ""), (6, "c", 7, "")], KIND)
    feed = mutate.kept_still(cdc.change_feed(before, after, ["id"]))
    # Only b is counted anew: a's greatest went but a greater one came, c's was replaced by its equal. So b's rows will do.
    only_b = after.where("g = 'b'")
    groups, _ = kept.refreshed(kept.groups(before), None, feed, only_b)
    assert rows(groups) == rows(kept.groups(after))
    # Without lost extremes the table isn't read at all.
    more = cdc.insert_changes(spark.createDataFrame([(7, "a", 3, "")], KIND))
    groups, _ = kept.refreshed(kept.groups(after), None, more, after.limit(0))
    assert rows(groups.where("g = 'a'")) == [("a", 3, 1, 9)]
    with pytest.raises(PySparkException, match="more rows deleted"):
        kept.refreshed(kept.groups(after), None, spark.createDataFrame([(i, "c", 7, "", "delete") for i in range(3)], KIND + ", _change_type string"), after)


def test_recluster_looks_at_new_folders_only(spark, tmp_path):
    path = str(tmp_path / "t")
    data = spark.range(2000).selectExpr("id", "cast(hash(id) % 1000 AS int) AS k", "cast(id % 3 AS string) AS p").withColumn(
        "p", F.when(F.col("p") == "2", None).otherwise(F.col("p")))
    data.where("p IS NULL OR p = '1'").repartition(4).write.partitionBy("p").parquet(path)
    layout.cluster_by(data.where("p = '0'"), ["k"], 4).write.mode("append").partitionBy("p").parquet(path)

    def files():
        found = spark.read.parquet(path).select(F.col("p").cast("string").alias("p"), F.col("_metadata.file_path").alias("f")).distinct().collect()
        return {p: {r.f for r in found if r.p == p} for p in {r.p for r in found}}

    start = files()
    report = {r.folder: (r.files, r.depth, r.rewritten) for r in layout.recluster(spark, path, "p", ["k"], target_bytes=4000).collect()}
    assert report == {None: (4, 4, True), "1": (4, 4, True), "0": (4, report["0"][1], False)} and report["0"][1] <= 2
    first = files()
    assert first["0"] == start["0"] and first["1"] != start["1"] and first[None] != start[None]
    assert rows(spark.read.parquet(path).select("id", "k", F.col("p").cast("string"))) == rows(data)
    assert max(r.depth for r in layout.overlap_depth(spark.read.parquet(path), "p", "k").collect()) <= 2
    # Nothing new: nothing is looked at, with whatever columns.
    assert layout.recluster(spark, path, "p", ["id", "k"]).count() == 0 and files() == first
    data.where("p = '1'").withColumn("p", F.lit("7")).repartition(4).write.mode("append").partitionBy("p").parquet(path)
    assert [(r.folder, r.rewritten) for r in layout.recluster(spark, path, "p", ["id", "k"]).collect()] == [("7", True)]
    assert {p: f for p, f in files().items() if p != "7"} == first
    assert spark.read.parquet(path).count() == 2000 + data.where("p = '1'").count()


def test_recluster_divides_rows_by_what_they_take_in_memory(spark, tmp_path):
    """Rows of 260 bytes that compress to almost nothing: a file's bytes say little of what its task has to sort."""
    path = str(tmp_path / "t")
    data = spark.range(2_500_000).select("id", (F.col("id") * 7919 % 100_003).alias("k"), F.lit("x" * 200).alias("text"), F.lit("a").alias("p"))
    data.repartition(4).write.partitionBy("p").parquet(path)
    report = layout.recluster(spark, path, "p", ["k"]).first()
    assert report.rewritten and report.bytes < layout.TARGET_BYTES // 4
    stored = spark.read.parquet(path)
    sizes = [r["count"] for r in stored.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert sum(sizes) == 2_500_000 and max(sizes) < 1_250_000
    assert stored.agg(F.sum("id"), F.sum("k")).first() == data.agg(F.sum("id"), F.sum("k")).first()
    assert layout.overlap_depth(stored, "p", "k").first().depth <= 2


def test_ranks_count_the_bounds_reached(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"))
    for bounds in ([], [5.0], [0.0, 10.0, 20.0, 99.0], [float(i) for i in range(0, 100, 7)]):
        got = df.select("x", layout._reached(F.col("x"), bounds, 0).alias("n")).collect()
        assert all(r.n == sum(b <= r.x for b in bounds) for r in got)


def test_small_frames_are_measured(spark):
    assert broadcast_if_small(spark.range(3), 0).columns == ["id"]
