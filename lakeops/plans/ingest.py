"""Sources and sinks: whole tables written to the shared scratch folder and read back."""

from __future__ import annotations

import re
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakeops.plans.bindings import MONEY, Tables, as_double
from lakeops.plans.registry import query
from lakeops.plans.sql import CUSTOMERS, FLAT, KEYED
from lakeops.sources import files, sweep, tables
from lakeops.streaming import io


def scratch_db(t: Tables) -> str:
    return tables.database(t.spark, f"lakeops_{uuid.uuid4().hex[:12]}", t.scratch("db"))


def _order_values(orders: DataFrame, *more: Column) -> DataFrame:
    """Items and value of each order: folded within the row, then over the records of an order."""
    value = F.aggregate("ordered_products", F.lit(0).cast("decimal(20,2)"),
                        lambda acc, p: (acc + p["price"].cast(MONEY) * p["qty"].cast("int")).cast("decimal(20,2)"))
    head = ["order_number", "order_datetime", "customer_id", "customer_name"]
    folded = orders.select(*head, F.size("ordered_products").cast("bigint").alias("_n"), value.alias("_v"), *more)
    return folded.groupBy(*[c for c in folded.columns if c not in ("_n", "_v")]).agg(
        F.sum("_n").alias("num_products"), F.sum("_v").alias("order_value"))


_ORDER_VALUES = f"""WITH {FLAT}
SELECT o_orderkey AS order_number, CAST(CAST(epoch(o_orderdate) AS BIGINT) AS VARCHAR) AS order_datetime,
       o_custkey AS customer_id, c_name AS customer_name, coalesce(n, 0) AS num_products,
       CAST(coalesce(v, 0) AS DOUBLE) AS order_value
FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN (SELECT order_number, count(*) AS n, sum(line_total) AS v FROM flat GROUP BY order_number)
  ON order_number = o_orderkey"""


@query("src_json_infer", _ORDER_VALUES)
def src_json_infer(t: Tables) -> DataFrame:
    path = t.scratch("json")
    t.sales_orders().write.json(path)
    return as_double(_order_values(files.read_json(t.spark, path)))


@query("src_json_schema", _ORDER_VALUES.replace("AS order_value", "AS order_value, true AS extra_is_null", 1))
def src_json_schema(t: Tables) -> DataFrame:
    path = t.scratch("json")
    t.sales_orders().write.json(path)
    schema = StructType([*files.SALES_ORDER.fields, StructField("number_of_line_items", LongType())])
    orders = files.read_json(t.spark, path, schema)
    return as_double(_order_values(orders, F.col("number_of_line_items").isNull().alias("extra_is_null")))


@query("src_csv_header", f"""WITH {CUSTOMERS}
SELECT CAST(customer_id AS VARCHAR) AS customer_id, customer_name, state, city, loyalty_segment FROM customers""")
def src_csv_header(t: Tables) -> DataFrame:
    path = t.scratch("csv")
    t.customers().write.option("header", True).csv(path)
    return files.read_csv(t.spark, path)


@query("src_parquet", "SELECT * FROM lineitem")
def src_parquet(t: Tables) -> DataFrame:
    return files.read_parquet(t.spark, f"{t.dir}/lineitem.parquet")


@query("src_table", f"""WITH {CUSTOMERS}
SELECT src, loyalty_segment, count(*) AS customers
FROM customers CROSS JOIN (VALUES ('name'), ('path')) s(src) GROUP BY src, loyalty_segment""")
def src_table(t: Tables) -> DataFrame:
    path = t.scratch("table")
    files.write_table(t.customers(), path)
    by_name = tables.save_table(t.customers(), f"{scratch_db(t)}.customers")
    by_path = t.spark.read.load(path)
    return (by_name.withColumn("src", F.lit("name")).unionByName(by_path.withColumn("src", F.lit("path")))
            .groupBy("src", "loyalty_segment").agg(F.count(F.lit(1)).alias("customers")))


@query("sink_overwrite", f"WITH {CUSTOMERS} SELECT customer_id, customer_name, state FROM customers")
def sink_overwrite(t: Tables) -> DataFrame:
    path = t.scratch("overwrite")
    files.write_table(t.customers().select("customer_id", "state"), path)
    files.write_table(t.customers().select("customer_id", "customer_name", "state"), path)
    return files.read_parquet(t.spark, path)


@query("sink_table", f"WITH {KEYED} SELECT order_number, state, CAST(line_total AS DOUBLE) AS line_total FROM keyed")
def sink_table(t: Tables) -> DataFrame:
    table = f"{scratch_db(t)}.orders"
    tables.save_table(t.customers(), table)  # replaced by the next write
    return as_double(tables.save_table(t.keyed_orders().select("order_number", "state", "line_total"), table))


@query("append_rows", f"WITH {CUSTOMERS} SELECT customer_id, customer_name, loyalty_segment FROM customers")
def append_rows(t: Tables) -> DataFrame:
    table = f"{scratch_db(t)}.customers"
    people = t.customers().select("customer_id", "customer_name", "loyalty_segment")
    builders = F.col("loyalty_segment") == "BUILDING"
    tables.save_table(people.where(builders), table)
    others = people.where(~builders).select("loyalty_segment", "customer_name", "customer_id")
    return tables.append(others, table)


@query("insert_values", f"""WITH {KEYED}
SELECT order_number, state, CAST(line_total AS DOUBLE) AS line_total FROM keyed
UNION ALL SELECT * FROM (VALUES (CAST(-999004 AS BIGINT), 'FL', CAST(45.0 AS DOUBLE)))""")
def insert_values(t: Tables) -> DataFrame:
    table = f"{scratch_db(t)}.orders"
    tables.save_table(t.keyed_orders().select("order_number", "state", "line_total"), table)
    t.spark.sql(f"INSERT INTO {table} VALUES (-999004, 'FL', 45.00)")
    return as_double(t.spark.table(table))


@query("ctas", f"""WITH {KEYED}
SELECT loyalty_segment, count(*) AS orders, CAST(sum(line_total) AS DOUBLE) AS revenue
FROM keyed GROUP BY loyalty_segment""")
def ctas(t: Tables) -> DataFrame:
    table = f"{scratch_db(t)}.orders"
    view = f"keyed_{uuid.uuid4().hex[:12]}"
    t.keyed_orders().createOrReplaceTempView(view)
    t.spark.sql(f"CREATE TABLE {table} USING parquet AS "
                f"SELECT order_number, loyalty_segment, line_total FROM {view}")
    return as_double(t.spark.table(table).groupBy("loyalty_segment").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("line_total").alias("revenue")))


@query("schema_merge", f"""WITH {KEYED}
SELECT order_number, state, CAST(line_total AS DOUBLE) AS line_total, CAST(NULL AS VARCHAR) AS data_source
FROM keyed WHERE status = 'F'
UNION ALL
SELECT order_number, state, CAST(line_total AS DOUBLE), 'external_api' FROM keyed WHERE status <> 'F'""")
def schema_merge(t: Tables) -> DataFrame:
    path = t.scratch("evolving")
    orders = t.keyed_orders()
    old = orders.where("status = 'F'").select("order_number", "state", "line_total")
    new = (orders.where("status <> 'F'").select("order_number", "state", "line_total")
           .withColumn("data_source", F.lit("external_api")))
    files.write_table(old, path, "append")
    files.write_table(new, path, "append")
    stored = files.read_parquet(t.spark, path, merge_schema=True)
    return as_double(stored)


_WRITTEN = f"WITH {KEYED} SELECT order_number, state, status, CAST(%s AS DOUBLE) AS line_total FROM keyed"


def _orders_table(t: Tables) -> str:
    table = f"{scratch_db(t)}.orders"
    tables.save_table(t.keyed_orders().select("order_number", "state", "status", "line_total"), table)
    return table


@query("update_table", _WRITTEN % "CASE WHEN state = 'NATION_7' THEN CAST(line_total * 0.9 AS DECIMAL(12,2)) ELSE line_total END")
def update_table(t: Tables) -> DataFrame:
    return as_double(tables.update_table(t.spark, _orders_table(t), {"line_total": "line_total * 0.9"}, "state = 'NATION_7'"))


@query("delete_table", _WRITTEN % "line_total" + " WHERE NOT (line_total < 10000)")
def delete_table(t: Tables) -> DataFrame:
    return as_double(tables.delete_table(t.spark, _orders_table(t), "line_total < 10000"))


@query("merge_table", f"""WITH {KEYED}
SELECT order_number, state, CASE WHEN status = 'O' OR order_number = 0 AND status = 'F' THEN 'M' ELSE status END AS status,
       CAST(CASE WHEN status = 'O' OR order_number = 0 AND status = 'F' THEN CAST(line_total * 1.1 AS DECIMAL(12,2)) ELSE line_total END AS DOUBLE) AS line_total FROM keyed
UNION ALL SELECT -order_number, state, 'M', CAST(CAST(line_total * 1.1 AS DECIMAL(12,2)) AS DOUBLE) FROM keyed WHERE status = 'F' AND order_number <> 0""")
def merge_table(t: Tables) -> DataFrame:
    """Open orders are updated; copies of the finished ones under new numbers are inserted."""
    number = F.when(F.col("status") == "F", -F.col("order_number")).otherwise(F.col("order_number"))
    changed = t.keyed_orders().where("status IN ('O', 'F')").select(
        number.alias("order_number"), "state", F.lit("M").alias("status"),
        F.expr("CAST(line_total * 1.1 AS DECIMAL(12,2))").alias("line_total"))
    return as_double(tables.merge_table(t.spark, _orders_table(t), changed, ["order_number"]))


def _orders_by_status(t: Tables) -> str:
    table = f"{scratch_db(t)}.orders"
    orders = t.keyed_orders().select("order_number", "state", "status", "line_total")
    tables.save_table(orders.repartition("status"), table, partition_by=["status"])
    return table


@query("update_partitioned", _WRITTEN % "CASE WHEN status = 'F' AND line_total > 100000 THEN CAST(line_total * 0.9 AS DECIMAL(12,2)) ELSE line_total END")
def update_partitioned(t: Tables) -> DataFrame:
    table = _orders_by_status(t)
    return as_double(tables.update_table(t.spark, table, {"line_total": "line_total * 0.9"}, "status = 'F' AND line_total > 100000"))


@query("move_partitioned", f"""WITH {KEYED}
SELECT order_number, state, CASE WHEN status = 'P' THEN 'O' WHEN line_total < 5000 THEN 'Small' ELSE status END AS status,
       CAST(line_total AS DOUBLE) AS line_total FROM keyed""")
def move_partitioned(t: Tables) -> DataFrame:
    """Rows move to other partitions: all of one, which goes, and some of the others, to a new one."""
    table = _orders_by_status(t)
    return as_double(tables.update_table(
        t.spark, table, {"status": "CASE WHEN status = 'P' THEN 'O' ELSE 'Small' END"}, "status = 'P' OR line_total < 5000"))


@query("delete_partitioned", _WRITTEN % "line_total" + " WHERE NOT (status = 'P' OR status = 'O' AND line_total < 10000)")
def delete_partitioned(t: Tables) -> DataFrame:
    return as_double(tables.delete_table(t.spark, _orders_by_status(t), "status = 'P' OR status = 'O' AND line_total < 10000"))


_FINISHED = "SELECT * FROM keyed WHERE status = 'F' AND line_total > 200000"


@query("merge_partitioned", f"""WITH {KEYED}
SELECT order_number, state, status, CAST(CASE WHEN status = 'F' AND line_total > 200000 THEN CAST(line_total * 1.1 AS DECIMAL(12,2)) ELSE line_total END AS DOUBLE) AS line_total
FROM keyed UNION ALL
SELECT -order_number, state, 'New', CAST(CAST(line_total * 1.1 AS DECIMAL(12,2)) AS DOUBLE) FROM ({_FINISHED}) WHERE order_number <> 0""")
def merge_partitioned(t: Tables) -> DataFrame:
    """Large finished orders are updated; copies of them under new numbers make a new partition."""
    big = t.keyed_orders().where("status = 'F' AND line_total > 200000")
    raised = F.expr("CAST(line_total * 1.1 AS DECIMAL(12,2))").alias("line_total")
    known = big.select("order_number", "state", "status", raised)
    fresh = big.where("order_number <> 0").select((-F.col("order_number")).alias("order_number"), "state", F.lit("New").alias("status"), raised)
    return as_double(tables.merge_table(t.spark, _orders_by_status(t), known.unionByName(fresh), ["order_number"]))


@query("partitions_kept", f"""WITH {KEYED} SELECT status, status <> 'F' AS kept FROM keyed GROUP BY status""")
def partitions_kept(t: Tables) -> DataFrame:
    """Which partitions still have the files they had before an update of some finished orders."""
    table = _orders_by_status(t)

    def stored() -> DataFrame:
        files_of = t.spark.table(table).select("status", F.col("_metadata.file_path").alias("file")).groupBy("status")
        return files_of.agg(F.sort_array(F.collect_set("file")).alias("files"))  # a row per partition

    path = t.scratch("stored")
    stored().write.parquet(path)
    tables.update_table(t.spark, table, {"line_total": "line_total * 0.9"}, "status = 'F' AND line_total > 100000")
    before = t.spark.read.parquet(path).withColumnRenamed("files", "old")
    return stored().join(before, "status").select("status", (F.col("files") == F.col("old")).alias("kept"))


@query("external_to_managed", f"""WITH {CUSTOMERS} SELECT kind, customer_id, customer_name, state
FROM customers CROSS JOIN (VALUES ('external'), ('managed')) k(kind)""")
def external_to_managed(t: Tables) -> DataFrame:
    db = scratch_db(t)
    people = t.customers().select("customer_id", "customer_name", "state")
    external = tables.external_table(people, f"{db}.outside", t.scratch("outside"))
    managed = tables.to_managed(t.spark, f"{db}.outside", f"{db}.inside")
    return external.withColumn("kind", F.lit("external")).unionByName(managed.withColumn("kind", F.lit("managed")))


@query("add_columns", f"""WITH {CUSTOMERS} SELECT customer_id, state, CAST(NULL AS VARCHAR) AS tier, CAST(NULL AS BIGINT) AS points FROM customers
UNION ALL SELECT -customer_id, state, 'new', 5 FROM customers""")
def add_columns(t: Tables) -> DataFrame:
    """Rows written before the columns were added read NULL."""
    table = f"{scratch_db(t)}.customers"
    people = t.customers().select("customer_id", "state")
    tables.save_table(people, table)
    tables.add_columns(t.spark, table, {"tier": ("string", "loyalty tier"), "points": ("bigint", "points so far")})
    return tables.append(people.select((-F.col("customer_id")).alias("customer_id"), "state", F.lit("new").alias("tier"),
                                       F.lit(5).cast("bigint").alias("points")), table)


@query("analyze_rows", "SELECT count(*) AS rows FROM orders")
def analyze_rows(t: Tables) -> DataFrame:
    """The row count that the statistics of an analysed table hold."""
    table = _orders_table(t)
    tables.analyze(t.spark, table)
    stats = t.spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Statistics'")
    return stats.select(F.regexp_extract("data_type", r"(\d+) rows", 1).cast("bigint").alias("rows"))


@query("cached_counts", f"WITH {KEYED} SELECT state, count(*) AS orders FROM keyed GROUP BY state")
def cached_counts(t: Tables) -> DataFrame:
    """Counts read from a cached table; the cache is dropped when the block ends."""
    table, path = _orders_table(t), t.scratch("counts")
    with tables.cached(t.spark, table) as orders:
        files.write_table(orders.groupBy("state").agg(F.count(F.lit(1)).alias("orders")), path)
    return files.read_parquet(t.spark, path)


@query("ingest_evolving", f"""WITH {CUSTOMERS}
SELECT customer_id, customer_name, NULL AS state, CAST(NULL AS VARCHAR) AS rescued FROM customers WHERE loyalty_segment = 'BUILDING'
UNION ALL
SELECT CASE WHEN customer_id % 2 = 0 THEN customer_id END, customer_name, state, CASE WHEN customer_id % 2 <> 0 THEN 'no ' || customer_id END
FROM customers WHERE loyalty_segment <> 'BUILDING'""")
def ingest_evolving(t: Tables) -> DataFrame:
    """Two batches of files: the second has a new column, and values that don't fit the type of a known one."""
    src, dst, kept, check = (t.scratch(n) for n in ("evolving-src", "evolving", "evolving-schema", "evolving-checkpoint"))
    people, first = t.customers(), F.col("loyalty_segment") == "BUILDING"
    mistyped = F.when(F.col("customer_id") % 2 != 0, F.concat(F.lit("no "), F.col("customer_id").cast("string")))
    people.where(first).select("customer_id", "customer_name").write.json(f"{src}/a")
    for k, batch in enumerate((None, people.where(~first))):
        if batch is not None:
            # The same field as a number or, where that is wanted, as a text.
            batch.where(mistyped.isNull()).select("customer_id", "customer_name", "state").write.json(f"{src}/b{k}")
            batch.where(mistyped.isNotNull()).select(mistyped.alias("customer_id"), "customer_name", "state").write.json(f"{src}/c{k}")
        io.ingest_evolving(t.spark, src, dst, kept, check)
    rows = io.read_evolving(t.spark, dst, kept)
    return rows.select("customer_id", "customer_name", "state", F.element_at(io.RESCUED, F.lit("customer_id")).alias("rescued"))


@query("join_reordered", """SELECT count(*) AS rows, true AS other_plan FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey WHERE c_custkey < 30""")
def join_reordered(t: Tables) -> DataFrame:
    """A join in the order written, and in the one that statistics make of it: other plans, the same rows."""
    db = scratch_db(t)
    for name in ("lineitem", "orders", "customer"):
        tables.save_table(t.read(name), f"{db}.{name}")
    text = f"""SELECT count(*) AS rows FROM {db}.lineitem JOIN {db}.orders ON l_orderkey = o_orderkey
               JOIN {db}.customer ON o_custkey = c_custkey WHERE c_custkey < 30"""

    def joined() -> tuple[int, list[str]]:
        df = t.spark.sql(text)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return df.first()["rows"], [n for n in re.findall(r"l_orderkey|o_custkey|c_custkey", plan) if n]

    plain = joined()
    for name in ("lineitem", "orders", "customer"):
        tables.analyze(t.spark, f"{db}.{name}", histograms=True)
    with tables.cost_based(t.spark):
        by_cost = joined()
    return t.spark.createDataFrame([(by_cost[0], by_cost[1] != plain[1])], "rows bigint, other_plan boolean").where(F.lit(plain[0] == by_cost[0]))


@query("sweep_files", f"WITH {KEYED} SELECT count(*) AS rows, true AS listed, 0 AS too_early, true AS gone, true AS readable FROM keyed WHERE status <> 'P'")
def sweep_files(t: Tables) -> DataFrame:
    """Files of a table that changes left behind: listed after the retention, not before it; removed, and the table still whole."""
    db, root = f"lakeops_{uuid.uuid4().hex[:12]}", t.scratch("sweep")
    table = f"{tables.database(t.spark, db, root)}.orders"
    tables.save_table(t.keyed_orders().select("order_number", "state", "status", "line_total"), table)
    left = {unquote(f) for f in t.spark.table(table).inputFiles()}
    tables.delete_table(t.spark, table, "status = 'P'")

    def run(at: str, dry_run: bool) -> set[str]:
        return {r["path"] for r in sweep.sweep(t.spark, root, [table], retention_hours=24, at=at, dry_run=dry_run).select("path").collect()}

    early = run("2024-01-01 00:00:00", False) | run("2024-01-01 23:00:00", False)
    due = run("2024-01-02 01:00:00", True)
    run("2024-01-02 02:00:00", False)
    names = lambda paths: {p.rsplit("/", 1)[1] for p in paths}
    there = names(r["path"] for r in sweep.files_under(t.spark, root).select("path").collect())
    return t.spark.table(table).agg(F.count(F.lit(1)).alias("rows"), F.lit(names(due) == names(left)).alias("listed"), F.lit(len(early)).alias("too_early"),
                                    F.lit(not there & names(left)).alias("gone"), (F.count("line_total") > 0).alias("readable"))
