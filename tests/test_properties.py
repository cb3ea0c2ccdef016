"""Random workloads against plain Python."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakeops.operators import cdc, mutate, rules, versions
from lakeops.plans.shaping import risk

SCHEMA = "k int, state string, total int"
KEY = ["k"]


def frame(spark, state):
    return spark.createDataFrame([(k, *v) for k, v in state.items()], SCHEMA)


def random_state(rng, n=60):
    # One third of the rows share a state value; some values are NULL.
    return {k: (rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, *range(5)]))
            for k in rng.sample(range(100), n)}


@pytest.mark.parametrize("seed", [1, 2])
def test_log_against_states_kept_in_python(spark, tmp_path, seed):
    rng = random.Random(seed)
    path = str(tmp_path / "log")
    states = [random_state(rng)]
    versions.commit(path, cdc.insert_changes(frame(spark, states[0])), 0, "2024-01-01")
    for v in range(1, 4):
        after = dict(states[-1])
        for k in rng.sample(sorted(after), 15):
            del after[k]
        after.update(random_state(rng, 25))
        versions.commit(path, cdc.change_feed(frame(spark, states[-1]), frame(spark, after), KEY), v, f"2024-01-0{v + 1}")
        states.append(after)
    log = versions.read_log(spark, path)
    for v, state in enumerate(states):
        assert rows(versions.as_of_version(log, KEY, v)) == rows(frame(spark, state))
    assert rows(versions.version_counts(log)) == [(v, len(s)) for v, s in enumerate(states)]

    first, last = states[0], states[-1]
    changed = {k: "added" if k not in first else "removed" if k not in last else "changed"
               for k in first.keys() | last.keys() if first.get(k) != last.get(k)}
    assert rows(versions.diff_versions(log, KEY, 0, 3).select("k", "change")) == rows(
        spark.createDataFrame(sorted(changed.items()), "k int, change string"))

    back = versions.restore(log, KEY, 1, 4, "2024-01-05")
    versions.commit(path, back.drop("_commit_version", "_commit_timestamp"), 4, "2024-01-05")
    assert rows(versions.as_of_version(versions.read_log(spark, path), KEY, 4)) == rows(frame(spark, states[1]))

    small = versions.compact_log(log, KEY, 2)
    assert rows(versions.as_of_version(small, KEY, 3)) == rows(frame(spark, states[3]))

    since = cdc.read_changes(log, from_version=2)
    assert rows(cdc.apply_changes(frame(spark, states[1]), since, KEY)) == rows(frame(spark, states[3]))
    assert rows(cdc.apply_changes(frame(spark, states[1]), since, KEY, broadcast_bytes=0)) == rows(frame(spark, states[3]))


@pytest.mark.parametrize("seed", [5, 6])
def test_merge_against_a_dict(spark, seed):
    rng = random.Random(seed)
    target, source = random_state(rng), random_state(rng, 30)
    want = dict(target)
    for k, (state, total) in source.items():
        if k not in want:
            want[k] = (state, total)
        elif total == 0:
            del want[k]
        else:
            want[k] = (want[k][0], total)
    out = mutate.merge(frame(spark, target), frame(spark, source), KEY, {"total": "source.total"},
                       delete_when="source.total = 0")
    assert rows(out) == rows(frame(spark, want))


def test_merge_updates_every_copy_of_a_hot_target_key(spark):
    target = spark.range(300).select(F.when(F.col("id") < 100, 1).otherwise(F.col("id")).cast("int").alias("k"),
                                     F.lit("x").alias("state"), F.lit(0).alias("total"))
    source = spark.createDataFrame([(1, "y", 9), (1000, "z", 9)], SCHEMA)
    for limit in (0, 1 << 20):
        out = mutate.merge(target, source, KEY, {"total": "source.total"}, broadcast_bytes=limit)
        assert out.where("k = 1 AND total = 9").count() == 100 and out.count() == 301


@pytest.mark.parametrize("limit", [1 << 20, 2000])
@pytest.mark.parametrize("hot", [7, None])
def test_merge_inserts_a_hot_unmatched_key_where_its_rows_lie(spark, tmp_path, hot, limit):
    target = spark.range(1000, 1300).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("state"), F.lit(0).alias("total"))
    key = F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(1000 + F.col("id"))
    spark.range(0, 6000, 1, 8).select(key.cast("int").alias("k"), F.lit("y").alias("state"), F.lit(9).alias("total")).where(
        "k IS NULL OR k = 7 OR k >= 1300").unionByName(target.withColumn("total", F.lit(5))).write.parquet(str(tmp_path / "s"))
    source = spark.read.parquet(str(tmp_path / "s"))
    out = mutate.merge(target, source, KEY, {"total": "source.total"}, broadcast_bytes=limit)
    got = Counter((r.k, r.state, r.total) for r in out.collect())
    want = Counter((r.k, r.state, r.total) for r in source.where("state = 'y'").collect())
    assert got == want + Counter((k, "x", 5) for k in range(1000, 1300)) and got[(hot, "y", 9)] == 2000
    placed = out.where("k <=> %s" % ("NULL" if hot is None else hot)).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in placed) < 1500


@pytest.mark.parametrize("seed", [8])
def test_valid_and_rejected_rows_make_up_the_table(spark, seed):
    df = frame(spark, random_state(random.Random(seed), 80))
    checks = [rules.Rule.not_null("state"), rules.Rule.check("small", "total < 3")]
    valid, rejected = rules.split_valid(df, checks)
    assert rows(valid.unionByName(rejected.drop("violations"))) == rows(df)
    counted = {r.rule: r.violations for r in rules.constraint_report(df, checks).collect()}
    named = {r.v: r.n for r in rejected.select(F.explode("violations").alias("v")).groupBy("v").agg(F.count("*").alias("n")).collect()}
    assert {k: v for k, v in counted.items() if v} == named


def test_risk_categories(spark):
    df = spark.createDataFrame([(g,) for g in ("A", "B", "C", "D", "E", None)], "loan_grade string")
    assert [r.r for r in df.select(risk("loan_grade", ("A", "B"), ("C", "D")).alias("r")).collect()] == [
        "Low", "Low", "Medium", "Medium", "High", "High"]
