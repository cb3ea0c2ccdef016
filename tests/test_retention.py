import pytest

from conftest import rows
from lakeops.operators import cdc, versions
from lakeops.operators.versions import VersionNotAvailable
from lakeops.sources import sweep, tables
from lakeops.streaming import io


@pytest.fixture
def db(spark, tmp_path):
    name = tables.database(spark, f"db_{tmp_path.name.replace('-', '_')}", str(tmp_path / "db"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_a_sweep_leaves_readers_their_time(spark, db, tmp_path):
    table, parted, log = f"{db}.t", f"{db}.p", str(tmp_path / "db" / "log")
    tables.save_table(spark.range(100), table)
    tables.save_table(spark.range(20).selectExpr("id", "id % 4 AS p"), parted, partition_by=["p"])
    versions.commit(log, cdc.insert_changes(spark.createDataFrame([(1, "a")], "id int, v string")), 0, "2024-01-01")
    reader, parts = spark.read.parquet(*spark.table(table).inputFiles()), spark.read.parquet(*spark.table(parted).inputFiles())
    tables.delete_table(spark, table, "id < 50")
    tables.delete_table(spark, parted, "p = 1 OR id = 2")
    named = ([table, parted], [log])

    def run(at, dry_run=False, names=named):
        return {r["path"] for r in sweep.sweep(spark, str(tmp_path / "db"), *names, retention_hours=10, at=at, dry_run=dry_run).collect()}

    # The files are old, but were named until now: nothing is due, and readers go on.
    assert run("2024-01-05 00:00:00") == set() and run("2024-01-05 09:59:00") == set()
    assert reader.count() == 100 and parts.count() == 20
    due = run("2024-01-05 10:00:00", dry_run=True)
    assert len(due) >= 3 and reader.count() == 100
    run("2024-01-05 11:00:00")
    assert spark.table(table).count() == 50 and spark.table(parted).count() == 14 and versions.read_log(spark, log).count() == 1
    left = {r["path"] for r in sweep.files_under(spark, str(tmp_path / "db")).collect()}
    assert not due & left
    # A file that is named again isn't forgotten by accident: what isn't given as named is noted anew, and kept for its time.
    assert run("2024-01-06 00:00:00", names=([table], [log])) == set()
    assert run("2024-01-07 00:00:00") == set() and spark.table(parted).count() == 14


def test_clones_and_bases_go_their_own_ways(spark, tmp_path):
    base, path = str(tmp_path / "base"), str(tmp_path / "clone")
    kind = "id int, v string"
    versions.commit(base, cdc.insert_changes(spark.createDataFrame([(1, "a"), (2, "b")], kind)), 0, "2024-01-01")
    with pytest.raises(VersionNotAvailable):
        versions.clone_writable(spark, str(base), ["id"], path + "-none", -1)
    clone = versions.clone_writable(spark, base, ["id"], path, 0)
    assert rows(clone) == [(1, "a"), (2, "b")]
    assert not list((tmp_path / "clone").rglob("log"))  # nothing but the pointer is written
    versions.commit(base, spark.createDataFrame([(1, "a", "delete"), (3, "c", "insert")], kind + ", _change_type string"), 1, "2024-01-02")
    versions.commit_clone(path, spark.createDataFrame([(2, "B", "update_postimage"), (9, "z", "insert")], kind + ", _change_type string"), 0, "2024-01-03")
    versions.commit_clone(path, spark.createDataFrame([(9, "z", "delete")], kind + ", _change_type string"), 1, "2024-01-04")
    assert rows(versions.read_clone(spark, path)) == [(1, "a"), (2, "B")]
    assert rows(versions.read_clone(spark, path, version=0)) == [(1, "a"), (2, "B"), (9, "z")]
    assert rows(versions.as_of_version(versions.read_log(spark, base), ["id"], 1)) == [(2, "b"), (3, "c")]


def test_no_value_is_lost_when_columns_change(spark, tmp_path):
    src, dst, kept, check = (str(tmp_path / n) for n in ("src", "dst", "schema", "check"))

    def land(name, *lines):
        (tmp_path / "src").mkdir(exist_ok=True)
        (tmp_path / "src" / name).write_text("\n".join(lines) + "\n")
        io.ingest_evolving(spark, src, dst, kept, check)

    land("a.json", '{"id": 1, "v": 1.5}', '{"id": 2, "v": null}')
    land("b.json", '{"id": "x7", "v": 2.5, "new": "n"}', '{"id": 4, "v": {"deep": 1}}', "not json", '{"other": true}')
    got = {(r["id"], r["v"], r["new"], r["other"], tuple(sorted((r[io.RESCUED] or {}).items()))) for r in io.read_evolving(spark, dst, kept).collect()}
    assert got == {(1, 1.5, None, None, ()), (2, None, None, None, ()), (None, 2.5, "n", None, (("id", "x7"),)),
                   (4, None, None, None, (("v", '{"deep":1}'),)), (None, None, None, None, (("", "not json"),)), (None, None, None, True, ())}
    before = rows(io.read_evolving(spark, dst, kept).select("id", "v", "new"))
    (tmp_path / "check" / "commits" / "1").unlink()
    (tmp_path / "check" / "commits" / ".1.crc").unlink(missing_ok=True)
    io.ingest_evolving(spark, src, dst, kept, check)  # the batch again
    assert rows(io.read_evolving(spark, dst, kept).select("id", "v", "new")) == before


def test_histograms_are_collected_and_settings_restored(spark, db):
    table = f"{db}.t"
    tables.save_table(spark.range(1000).selectExpr("id", "id % 10 AS k"), table)
    tables.analyze(spark, table, histograms=True)
    told = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {table} id").collect()}
    assert "bin_0" in " ".join(told) or told.get("histogram", "NULL") != "NULL"
    assert spark.conf.get("spark.sql.statistics.histogram.enabled") == "false"
    with tables.cost_based(spark):
        assert spark.conf.get("spark.sql.cbo.enabled") == "true"
    assert spark.conf.get("spark.sql.cbo.enabled") == "false"
