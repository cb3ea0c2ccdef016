from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from lakeops.functions import band, bin_width
from lakeops.operators import aggregates, orders
from lakeops.plans.bindings import Tables

SCHEMA = ("order_number long, record_no long, order_datetime string, customer_id long, customer_name string, "
          "ordered_products array<struct<name:string,price:decimal(12,2),qty:int>>")


def sample(spark):
    return spark.createDataFrame([
        (1, 0, "1546300800", 10, "Ann", [("pen", Decimal("2.50"), 4), ("ink", Decimal("60.00"), 1)]),
        (2, 0, "", 11, "Bob", []),
        (3, 0, "not a time", 10, "Ann", None),
        (4, 0, None, 12, "Cy", [("cap", Decimal("50.00"), 2)]),
    ], SCHEMA)


def test_explode_drops_empty_orders_and_outer_keeps_them(spark):
    inner = orders.explode_orders(sample(spark), ["order_number"])
    assert rows(inner.select("order_number", "product_name", "line_total")) == [
        (1, "ink", Decimal("60.00")), (1, "pen", Decimal("10.00")), (4, "cap", Decimal("100.00"))]
    outer = orders.explode_orders(sample(spark), ["order_number"], outer=True)
    assert rows(outer.where("product_name IS NULL").select("order_number")) == [(2,), (3,)]


def test_order_time_gives_null_for_text_that_is_no_number(spark):
    timed = orders.with_order_time(sample(spark)).select("order_number", F.col("order_date").cast("string"))
    assert rows(timed) == [(1, "2019-01-01"), (2, None), (3, None), (4, None)]


def test_exists_filter_is_strict_and_skips_null_arrays(spark):
    assert rows(orders.orders_with_item_over(sample(spark), 50).select("order_number")) == [(1,)]


def test_empty_arrays_counts_null_and_empty(spark):
    assert rows(orders.empty_arrays(sample(spark)).select("order_number")) == [(2,), (3,)]


def test_enrich_keeps_orders_whose_name_or_id_differs(spark):
    people = spark.createDataFrame([(10, "Ann", "NY"), (11, "Rob", "CA")],
                                   "customer_id long, customer_name string, state string")
    out = orders.enrich_orders(sample(spark), people).select("order_number", "state")
    assert rows(out) == [(1, "NY"), (2, None), (3, "NY"), (4, None)]


def test_band_edges_and_null(spark):
    df = spark.createDataFrame([(99.99,), (100.0,), (499.99,), (500.0,), (None,)], "v double")
    out = df.select(band("v", [100, 500], ["Small", "Medium", "Large"]).alias("b")).collect()
    assert [r.b for r in out] == ["Small", "Medium", "Medium", "Large", "Large"]


def test_bin_width_of_negative_values(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (99.0,), (250.5,)], "v double")
    assert [r.b for r in df.select(bin_width("v", 100).alias("b")).collect()] == [-100, 0, 0, 200]


def test_hot_order_is_spread_over_records_and_loses_nothing(spark):
    hot = spark.range(1000).select(F.lit(7).cast("long").alias("order_number"), F.col("id").cast("int").alias("qty"))
    cold = spark.range(50).select((F.col("id") + 100).alias("order_number"), F.lit(1).alias("qty"))
    lines = hot.unionByName(cold).withColumn("place", F.monotonically_increasing_id())
    item = F.struct(F.lit("x").alias("name"), F.lit(Decimal("1.00")).cast("decimal(12,2)").alias("price"), "qty")
    nested = orders.nest_lines(lines, "order_number", item, "ordered_products", "place", items_per_record=100)
    sizes = nested.select("order_number", F.size("ordered_products").alias("n"))
    hot_sizes = [r.n for r in sizes.where("order_number = 7").collect()]
    assert len(hot_sizes) == 10 and sum(hot_sizes) == 1000 and max(hot_sizes) <= 200
    flat = orders.explode_orders(nested, ["order_number"])
    assert rows(flat.where("order_number = 7").agg(F.sum("quantity"))) == [(999 * 500,)]
    # Order counts and sizes per customer are the same as with one record per order.
    items = aggregates.nested_sizes(nested, ["order_number"], "ordered_products", "items")
    stats = aggregates.report(items, [], {"orders": "count(*)", "items": "sum(items)"}).first()
    assert (stats.orders, stats.items) == (51, 1050)


@pytest.mark.parametrize("stride", [2, 3, 10])
def test_a_hot_order_at_regular_places_is_spread_too(spark, stride):
    lines = spark.range(400 * stride).where(F.col("id") % stride == 1).select(F.lit(7).alias("order_number"), F.col("id").alias("place"))
    nested = orders.nest_lines(lines, "order_number", F.col("place"), "items", "place", items_per_record=40)
    sizes = [r.n for r in nested.select(F.size("items").alias("n")).collect()]
    assert len(sizes) == 10 and sum(sizes) == 400 and max(sizes) <= 80


def test_nesting_counts_keys_without_the_join(spark):
    plan = Tables(spark, SF_SMALL).sales_orders()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("part.parquet") == 1


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "k string, v int")
    assert [r.k for r in aggregates.top_k(df, "v", 2, ["k"]).collect()] == ["c", "a"]


def test_column_summary_quartiles(spark):
    row = aggregates.column_summary(spark.range(1, 101), ["id"]).first()
    assert (row["count"], row["min"], row["max"], row["q50"]) == (100.0, 1.0, 100.0, 50.0)
