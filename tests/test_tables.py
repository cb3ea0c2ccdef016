import pytest
from pyspark.sql import functions as F

from conftest import SF, rows
from lakeops.operators import joins, layout, mutate
from lakeops.operators.rules import RuleViolation
from lakeops.plans import QUERIES
from lakeops.session import path_bytes, scratch_dir
from lakeops.sources import files, tables


def files_touched(spark, path, condition):
    """How many files hold rows that meet a condition."""
    return (spark.read.parquet(path).where(condition)
            .select(F.col("_metadata.file_path").alias("file")).distinct().count())


@pytest.fixture
def db(spark, tmp_path):
    name = tables.database(spark, f"db_{tmp_path.name.replace('-', '_')}", str(tmp_path / "db"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_append_matches_by_name_and_rejects_what_does_not_fit(spark, db):
    table = f"{db}.t"
    tables.save_table(spark.createDataFrame([(1, "a")], "id int, v string"), table)
    tables.append(spark.createDataFrame([("b", 2)], "v string, id int"), table)
    assert rows(spark.table(table)) == [(1, "a"), (2, "b")]
    for schema, row in (("id int", (3,)), ("id int, v string, x int", (3, "c", 1)), ("id string, v string", ("3", "c"))):
        with pytest.raises(RuleViolation):
            tables.append(spark.createDataFrame([row], schema), table)
    assert spark.table(table).count() == 2


def test_external_and_managed_tables(spark, db, tmp_path):
    external = tables.external_table(spark.range(5), f"{db}.ext", str(tmp_path / "ext"))
    assert external.count() == 5
    managed = tables.to_managed(spark, f"{db}.ext", f"{db}.own")
    assert rows(managed) == rows(external)
    spark.sql(f"DROP TABLE {db}.ext")
    assert spark.read.parquet(str(tmp_path / "ext")).count() == 5  # dropping leaves the files


def test_added_columns_read_null_for_old_rows(spark, db):
    table = f"{db}.t"
    tables.save_table(spark.createDataFrame([(1,)], "id int"), table)
    tables.add_columns(spark, table, {"discount": ("DOUBLE", "share taken off"), "seen": ("TIMESTAMP", "last update")})
    spark.sql(f"INSERT INTO {table} VALUES (2, 0.5, NULL)")
    assert rows(spark.table(table).select("id", "discount")) == [(1, None), (2, 0.5)]
    assert spark.table(table).schema["discount"].metadata["comment"] == "share taken off"


def test_statistics_and_cache(spark, db):
    table = f"{db}.t"
    tables.save_table(spark.range(100), table)
    tables.analyze(spark, table)
    stats = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Statistics'").first()["data_type"]
    assert "100 rows" in stats
    with tables.cached(spark, table) as kept:
        assert spark.catalog.isCached(table)
        seconds, n = tables.timed(kept.count)
        assert n == 100 and seconds >= 0
    assert not spark.catalog.isCached(table)


def test_json_with_schema_gives_null_for_missing_fields(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "order_number long, customer_name string").write.json(str(tmp_path / "j"))
    row = files.read_json(spark, str(tmp_path / "j"), files.SALES_ORDER).first()
    assert (row.order_number, row.customer_name, row.ordered_products) == (1, "x", None)


def test_parquet_schemas_merge_on_read(spark, tmp_path):
    path = str(tmp_path / "p")
    files.write_table(spark.createDataFrame([(1,)], "a int"), path, "append")
    files.write_table(spark.createDataFrame([(2, "x")], "a int, b string"), path, "append")
    assert rows(files.read_parquet(spark, path, merge_schema=True)) == [(1, None), (2, "x")]


def test_compaction_packs_small_files_without_a_shuffle(spark, tmp_path):
    src, dst = str(tmp_path / "small"), str(tmp_path / "big")
    df = spark.range(200_000).withColumn("v", F.xxhash64("id").cast("decimal(20,0)"))
    df.repartition(40).write.parquet(src)
    size = path_bytes(spark, src)
    out = layout.compact(spark, src, dst, target_bytes=size // 4 + 1)
    n = out.select(F.col("_metadata.file_path")).distinct().count()
    assert 3 <= n <= 6
    assert out.agg(F.sum("v")).first() == df.agg(F.sum("v")).first() and out.count() == 200_000


def test_zorder_and_range_order_touch_few_files(spark, tmp_path):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_partkey", "l_suppkey", "l_shipdate", "l_returnflag")
    plain, z, r = (str(tmp_path / n) for n in ("plain", "z", "r"))
    lines.repartition(32).write.parquet(plain)
    layout.zorder(lines, ["l_partkey", "l_shipdate"], 32).write.parquet(z)
    layout.cluster_by(lines, ["l_partkey"], 32).write.parquet(r)
    by_part = F.col("l_partkey") == 700
    by_month = F.col("l_shipdate").between("1997-03-01", "1997-03-10")
    assert files_touched(spark, plain, by_part) >= 15
    assert files_touched(spark, z, by_part) <= 12
    assert files_touched(spark, z, by_month) <= 12 < files_touched(spark, plain, by_month)
    assert files_touched(spark, r, by_part) <= 2
    for path in (z, r):
        assert rows(spark.read.parquet(path).groupBy("l_returnflag").count()) == rows(lines.groupBy("l_returnflag").count())


def test_zorder_takes_strings_nulls_and_hot_values(spark, tmp_path):
    df = spark.range(4000).select(
        F.when(F.col("id") < 1500, "hot").when(F.col("id") < 1600, F.lit(None)).otherwise(F.hex("id")).alias("s"),
        F.when(F.col("id") % 7 != 0, F.col("id")).alias("n"))
    path = str(tmp_path / "z")
    layout.zorder(df, ["s", "n"], 8).write.parquet(path)
    sizes = [x["count"] for x in spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 1500
    layout.cluster_by(df, ["s"], 8).write.parquet(path + "1")
    sizes = [x["count"] for x in spark.read.parquet(path + "1").groupBy(F.col("_metadata.file_path")).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 1500


def test_zorder_takes_the_whole_text(spark, tmp_path):
    df = spark.range(4000).select(F.concat(F.lit("Customer#"), F.lpad((F.col("id") % 1000).cast("string"), 9, "0")).alias("name"),
                                  (F.col("id") * 7919 % 4000).alias("n"))
    path = str(tmp_path / "z")
    layout.zorder(df, ["name", "n"], 64).write.parquet(path)
    assert files_touched(spark, path, F.col("name") == "Customer#000000412") <= 4
    assert files_touched(spark, path, F.col("n").between(100, 150)) <= 24


def test_layouts_get_more_files_than_cores_where_tasks_would_sort_too_much(spark, monkeypatch):
    monkeypatch.setattr(layout, "SORTED_BYTES", 1 << 18, raising=False)
    for name, table in (("zorder_rows", "lineitem"), ("cluster_rows", "orders")):
        got, given = QUERIES[name](spark, SF), spark.read.parquet(f"{SF}/{table}.parquet")
        sizes = [r["count"] for r in got.groupBy(F.col("_metadata.file_path")).count().collect()]
        most = (1 << 18) // 64  # a row takes more than that
        assert len(sizes) > spark.sparkContext.defaultParallelism // 2 and max(sizes) < most and sum(sizes) == given.count()
        assert got.exceptAll(given.select(*got.columns)).isEmpty()


def test_publishing_reads_the_table_itself_and_keeps_old_readers(spark, db):
    table = f"{db}.t"
    tables.save_table(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string"), table)
    old = spark.read.parquet(tables.location(spark, table))
    tables.update_table(spark, table, {"v": "upper(v)"}, "id < 3")
    tables.delete_table(spark, table, "id = 2")
    tables.merge_table(spark, table, spark.createDataFrame([(1, "z"), (9, "n")], "id int, v string"), ["id"])
    assert rows(spark.table(table)) == [(1, "z"), (3, None), (9, "n")]
    assert rows(old) == [(1, "a"), (2, "b"), (3, None)]
    with pytest.raises(RuleViolation):
        tables.publish(spark.table(table).drop("v"), table)
    assert spark.table(table).count() == 3


def brute_overlaps(report):
    return {r.file: sum(1 for o in report if o.file != r.file and o.min <= r.max and o.max >= r.min) for r in report}


def test_layout_report_counts_overlaps(spark, tmp_path):
    path = str(tmp_path / "t")
    for lo, hi in ((0, 10), (10, 20), (5, 30), (40, 50), (40, 41), (60, 61)):
        spark.range(lo, hi + 1).coalesce(1).write.mode("append").parquet(path)
    report = layout.layout_report(spark, path, "id").collect()
    assert {r.file: r.overlaps for r in report} == brute_overlaps(report)
    assert sum(r.rows for r in report) == spark.read.parquet(path).count() and all(r.bytes > 0 for r in report)


def test_partition_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    files.write_table(spark.range(100).withColumn("flag", F.col("id") % 3), path, partition_by=["flag"])
    plan = files.read_parquet(spark, path).where("flag = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(flag" in plan


def test_orphans_ignore_null_keys_and_repeated_parents(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "id int, p int")
    parent = spark.createDataFrame([(10,), (10,), (12,)], "pk int")
    assert rows(joins.orphans(child, parent, {"p": "pk"})) == [(2, 11)]


def test_scratch_follows_the_session_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(base) and scratch_dir(spark, "x") != scratch_dir(spark, "x")


def by_partition(spark, table):
    """Files of each partition."""
    found = spark.table(table).select("p", F.col("_metadata.file_path").alias("f")).distinct().collect()
    return {p: {r.f for r in found if r.p == p} for p in {r.p for r in found}}


def test_row_changes_of_partitioned_tables_touch_their_partitions_only(spark, db):
    table = f"{db}.t"
    odd = [None, "a/b", "it's", "x y", "back\\slash", "50%"]
    data = [(i, odd[i % 6], i * 10) for i in range(60)]
    tables.save_table(spark.createDataFrame(data, "id int, p string, v int"), table, partition_by=["p"])
    before = by_partition(spark, table)
    tables.update_table(spark, table, {"v": "v + 1"}, "id < 12 AND p = 'a/b'")
    after = by_partition(spark, table)
    assert {p for p in before if before[p] != after[p]} == {"a/b"}
    want = {i: (p, v + 1 if i < 12 and p == "a/b" else v) for i, p, v in data}
    assert {r.id: (r.p, r.v) for r in spark.table(table).collect()} == want
    # Every partition, by values that need quoting; rows that move; a partition that goes.
    tables.update_table(spark, table, {"v": "-v"}, "v >= 0")
    tables.update_table(spark, table, {"p": F.lit("new")}, "p IS NULL OR id = 1")
    tables.delete_table(spark, table, "p = '50%'")
    want = {i: ("new" if p is None or i == 1 else p, -v) for i, (p, v) in want.items() if p != "50%"}
    assert {r.id: (r.p, r.v) for r in spark.table(table).collect()} == want
    assert tables.partitions_listed(spark, table) == {(p,) for p, _ in want.values()}
    # The sources of a merge meet some partitions; one inserted row goes to another, present one.
    before = by_partition(spark, table)
    source = spark.createDataFrame([(2, "it's", 5), (500, "x y", 6), (501, None, 7)], "id int, p string, v int")
    tables.merge_table(spark, table, source, ["id"], set={"v": "source.v"})
    want |= {2: ("it's", 5), 500: ("x y", 6), 501: (None, 7)}
    assert {r.id: (r.p, r.v) for r in spark.table(table).collect()} == want
    after = by_partition(spark, table)
    assert {p for p in before if before[p] != after[p]} == {"it's", "x y"}


def test_several_partition_columns(spark, db):
    table = f"{db}.t"
    rows_ = spark.range(40).selectExpr("id", "id % 4 AS a", "date_add(date'2024-01-01', int(id % 3)) AS b")
    tables.save_table(rows_, table, partition_by=["a", "b"])
    tables.delete_table(spark, table, "a = 1 AND b = date'2024-01-02' OR id = 0")
    want = rows_.where("NOT (a = 1 AND b = date'2024-01-02' OR id = 0)")
    assert rows(spark.table(table)) == rows(want)
    tables.update_table(spark, table, {"a": "a + 10"}, "a = 2")
    assert rows(spark.table(table)) == rows(want.withColumn("a", F.expr("CASE WHEN a = 2 THEN 12 ELSE a END")))
    assert tables.update_table(spark, table, {"a": "0"}, "id = 99").count() == want.count()


def test_a_partitioned_table_is_published_whole(spark, db):
    table = f"{db}.t"
    first = spark.range(10).selectExpr("id", "id % 3 AS p")
    tables.save_table(first, table, partition_by=["p"])
    old = spark.table(table).inputFiles()
    tables.publish(spark.table(table).withColumn("id", F.col("id") + 100), table)
    assert rows(spark.table(table)) == rows(first.withColumn("id", F.col("id") + 100))
    assert spark.read.parquet(*old).count() == 10  # readers of the old files go on
    tables.save_table(first.where("p = 1"), table)
    assert rows(spark.table(table)) == rows(first.where("p = 1"))


def test_a_failing_write_leaves_the_table(spark, db):
    table = f"{db}.t"
    tables.save_table(spark.range(5), table)
    broken = spark.range(5).selectExpr("id", "raise_error('no') AS other")
    with pytest.raises(Exception, match="no"):
        tables.save_table(broken.withColumn("other", F.col("other").cast("int")), table)
    assert spark.table(table).count() == 5
    # Other columns, from the table itself.
    tables.save_table(spark.table(table).withColumn("twice", F.col("id") * 2), table)
    assert rows(spark.table(table)) == [(i, 2 * i) for i in range(5)]
    tables.save_table(spark.table(table), table, partition_by=["twice"])
    assert tables.partition_columns(spark, table) == ["twice"] and spark.table(table).count() == 5


def test_a_merge_computes_its_source_once(spark):
    source = spark.range(20).select("id", F.rand().alias("v"))
    target = spark.createDataFrame([(1, 0.0)], "id long, v double")
    for limit in (0, 1 << 20):
        merged = mutate.merge(target, source, ["id"], broadcast_bytes=limit)
        assert sorted(r.id for r in merged.collect()) == list(range(20))
    tables_void = source.withColumn("n", F.lit(None))
    assert mutate.merge(target.withColumn("n", F.lit(1)), tables_void, ["id"]).where("n IS NULL").count() == 20
