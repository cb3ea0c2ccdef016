import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation, functions as F

from conftest import rows
from lakeops.operators import privacy, profile, rules, sampling, schema
from lakeops.operators.rules import Rule, RuleViolation

LOANS = "loan_amnt int, funded_amnt int, addr_state string"
RULES = [Rule.not_null("loan_amnt"), Rule.check("valid_amount", "loan_amnt > 0 AND loan_amnt <= 50000"),
         Rule.check("valid_funded", "funded_amnt >= 0 AND funded_amnt <= loan_amnt")]


def loans(spark, *data):
    return spark.createDataFrame(list(data), LOANS)


GOOD = [(15000, 15000, "CA"), (25000, 25000, "NY"), (10000, 10000, "TX")]


def test_enforce_passes_good_rows(spark):
    assert rules.enforce(loans(spark, *GOOD), RULES).count() == 3


def test_enforce_raises_on_null_and_on_failed_check(spark):
    with pytest.raises(RuleViolation, match="loan_amnt_not_null"):
        rules.enforce(loans(spark, *GOOD, (None, 10000, "CA")), RULES)
    with pytest.raises(RuleViolation, match="valid_amount"):
        rules.enforce(loans(spark, *GOOD, (100000, 10000, "CA")), RULES)


def test_guard_fails_the_write_and_leaves_nothing(spark, tmp_path):
    rules.guard(loans(spark, *GOOD), RULES).write.parquet(str(tmp_path / "good"))
    assert spark.read.parquet(str(tmp_path / "good")).count() == 3
    with pytest.raises(PySparkException, match="constraint violated: valid_amount"):
        rules.guard(loans(spark, *GOOD, (100000, 1, "CA")), RULES).write.parquet(str(tmp_path / "bad"))
    assert not [f for f in (tmp_path / "bad").glob("*.parquet")]


def test_observed_expectations_of_a_batch(spark):
    seen = Observation("checks")
    kept = rules.expect(loans(spark, *GOOD, (None, 1, "CA")), {"positive": ("loan_amnt > 0", "drop")}, seen)
    assert kept.count() == 3
    assert seen.get == {"_records": 4, "positive": 1}


def test_null_passes_check_but_fails_expectation(spark):
    df = loans(spark, (15000, None, "CA"))
    assert rules.enforce(df, RULES).count() == 1
    assert rules.expect(df, {"funded": ("funded_amnt >= 0", "drop")}).count() == 0
    assert rules.expect(df, {"funded": "funded_amnt >= 0"}).count() == 1  # warn is the default


def test_both_parts_are_written_in_one_pass(spark, tmp_path):
    df = loans(spark, (100, 50, "CA"), (None, 5, "NY"), (100, 200, None))
    want = rules.split_valid(df, RULES)
    got = rules.write_split(df, RULES, str(tmp_path / "split"))
    assert [rows(p) for p in got] == [rows(p) for p in want] and got[0].columns == df.columns


def test_split_valid_is_a_partition_with_all_reasons(spark):
    df = loans(spark, *GOOD, (None, 5, "CA"), (-1, 5, "CA"))
    valid, rejected = rules.split_valid(df, RULES)
    assert valid.count() == 3
    assert rows(rejected.select("loan_amnt", F.array_join("violations", ","))) == [
        (None, "loan_amnt_not_null"), (-1, "valid_amount,valid_funded")]


def test_fail_expectation_aborts(spark):
    df = loans(spark, *GOOD, (0, 0, "CA"))
    with pytest.raises(PySparkException, match="expectation failed: positive"):
        rules.expect(df, {"positive": ("loan_amnt > 0", "fail")}).collect()
    with pytest.raises(ValueError):
        rules.expect(df, {"positive": ("loan_amnt > 0", "explode")})


def test_expectation_metrics(spark):
    df = loans(spark, (1, 1, "CA"), (None, 1, "CA"), (-1, 1, "CA"), (2, 1, "CA"))
    out = rules.expectation_metrics(df, {"positive": "loan_amnt > 0"}).first()
    assert (out.passed_records, out.failed_records, float(out.failure_rate)) == (2, 2, 50.0)


def test_reports_on_an_empty_table(spark):
    df = loans(spark, *GOOD).where("false")
    assert {r.null_count for r in profile.null_profile(df).collect()} == {0}
    assert tuple(profile.duplicate_rows(df).first()) == (0, 0, 0)
    assert {r.violations for r in rules.constraint_report(df, RULES).collect()} == {0}


def test_duplicates_over_all_columns_and_over_keys(spark):
    df = loans(spark, (1, 1, "CA"), (1, 1, "CA"), (1, 2, "CA"), (None, None, None), (None, None, None))
    assert tuple(profile.duplicate_rows(df).first()) == (5, 3, 2)
    assert tuple(profile.duplicate_rows(df, ["addr_state"]).first()) == (5, 2, 3)


def test_violation_examples(spark):
    df = loans(spark, *GOOD, (None, 5, "CA"), (-1, 5, "CA"))
    assert rows(profile.violation_examples(df, F.col("loan_amnt") <= 0)) == [(-1, 5, "CA")]


def test_check_schema(spark):
    df = loans(spark, *GOOD)
    assert rules.check_schema(df.select("addr_state", "loan_amnt", "funded_amnt"), df.schema).columns == df.columns
    for bad in (df.drop("loan_amnt"), df.withColumn("x", F.lit(1)), df.withColumn("loan_amnt", F.lit("a"))):
        with pytest.raises(RuleViolation):
            rules.check_schema(bad, df.schema)


def test_identity_is_dense_and_ordered_with_hot_ties(spark):
    df = spark.range(3000).withColumn("k", F.when(F.col("id") < 1500, F.lit(5)).otherwise(F.col("id") % 10))
    out = schema.assign_identity(df, ["k"], "n", start=100, partitions=6)
    got = sorted((r.n, r.k) for r in out.collect())
    assert [n for n, _ in got] == list(range(100, 3100))
    assert [k for _, k in got] == sorted(k for _, k in got)


def test_identity_spreads_a_hot_value(spark):
    from lakeops.operators.skew import range_slices
    sliced = range_slices(spark.range(4000).withColumn("k", F.lit(1)), ["k"], 4)
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 2000


def test_defaults_and_audit(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, tag string")
    out = schema.with_defaults(df, {"tag": F.lit("none"), "extra": F.col("id") * 2})
    assert rows(out) == [(1, "none", 2), (2, "x", 4)]
    assert schema.with_audit(df, "api").where("last_updated IS NULL").count() == 0


def test_append_merge_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, 3.0)], "id int, b double")
    assert rows(schema.append_merge(a, b)) == [(1, "x", None), (2, None, 3.0)]


def test_masks_and_row_filter(spark):
    df = spark.createDataFrame([("Ann 9", "NY"), ("Bob", "CA")], "name string, state string")
    grants = spark.createDataFrame([("u1", "NY"), ("u1", "NY"), ("u2", "CA")], "user string, state string")
    assert rows(privacy.mask_cols(privacy.row_filter(df, grants, "u1", ["state"]), {"name": "redact"})
                .select("name")) == [("Xxx n",)]
    hashed = privacy.mask_cols(df, {"name": "hash"}).first()["name"]
    assert len(hashed) == 64
    with pytest.raises(ValueError):
        privacy.mask_cols(df, {"name": "blur"})


def test_random_int_covers_its_range(spark):
    got = {r.v for r in sampling.with_random_int(spark.range(500), "v", 1, 4, seed=1).collect()}
    assert got == {1, 2, 3, 4}


def test_hash_sample_is_near_its_share(spark):
    n = sampling.sample_hash(spark.range(100_000), "id", 100).count()
    assert 9_000 < n < 11_000


def test_batches_are_disjoint_and_complete(spark, tmp_path):
    sampling.split_into_batches(spark.range(500), 5, ["id"], str(tmp_path / "b"))
    back = spark.read.json(str(tmp_path / "b"))
    assert back.count() == 500 and back.select("id").distinct().count() == 500
    assert back.select("batch_id").distinct().count() == 5


def test_alerts_flag_gap_low_count_and_growth(spark):
    days = [(f"2024-01-{d:02d}", 100, f"2024-01-{d:02d} 10:00:00", 0) for d in range(1, 9)]
    days += [("2024-01-11", 50, "2024-01-11 10:00:00", 1)]
    df = spark.createDataFrame(days, "day string, record_count long, last_update string, violations long")
    df = df.withColumn("day", F.to_date("day")).withColumn("last_update", F.to_timestamp_ntz("last_update"))
    out = {str(r.day): r for r in profile.alerts(df).collect()}
    last = out["2024-01-11"]
    assert last.low_count and last.stale and last.dirty and last.growth
    assert not out["2024-01-02"].low_count and not out["2024-01-02"].stale
    assert out["2024-01-08"].growth  # 800 rows, a week before 100


def test_generated_columns_are_computed_or_checked(spark):
    df = spark.createDataFrame([(2, 5, 10), (3, 4, None)], "a int, b int, area int")
    area = {"area": F.col("a") * F.col("b")}
    assert rows(schema.with_generated(df, area)) == [(2, 5, 10), (3, 4, 12)]
    assert rows(schema.with_generated(df.drop("area"), area)) == [(2, 5, 10), (3, 4, 12)]
    with pytest.raises(PySparkException, match="generated value"):
        schema.with_generated(df.na.fill(1), area).collect()
