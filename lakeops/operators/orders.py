"""Nested sales orders: building, enriching, flattening and filtering them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.functions import epoch_to_timestamp
from lakeops.operators.skew import group_sizes

# Items of an order that are kept together in one record (see nest_lines).
ITEMS_PER_RECORD = 100_000


def nest_lines(lines: DataFrame, key: str, item: Column, name: str, place: str, keys: DataFrame | None = None,
               items_per_record: int = ITEMS_PER_RECORD) -> DataFrame:
    """Gather `item` of all rows of a key into array records `(key, record_no, name)`.

    A key of n rows is spread over `ceil(n / items_per_record)` records of about equal size by a
    hash of `place`, a column that numbers the rows where they are scanned: no array, and no task,
    holds a whole hot key, and no row is lost. Most keys have one record, number 0; readers take an
    order's records together. The plan is the same for all sizes and runs with the result:
    `keys`, a frame of the key column alone, says cheaply how many rows a key has where `lines`
    is itself a join.
    """
    counted = group_sizes(lines.select(key) if keys is None else keys, [key])
    hot = counted.where(F.col("_n") > items_per_record).select(
        F.col(key).alias("_hot"), F.ceil(F.col("_n") / items_per_record).alias("_pages"))
    dealt = F.expr(f"pmod(xxhash64({place}), coalesce(_pages, 1))")
    paged = (lines.select(key, place, item.alias("_item")).join(hot, F.col(key) == F.col("_hot"), "left")
             .withColumn("record_no", dealt))
    # By key and record, so that a hot key's records go to different tasks.
    return (paged.repartition(key, "record_no").groupBy(key, "record_no")
            .agg(F.collect_list("_item").alias(name)))


def enrich_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Left join on customer id and name: orders of unknown customers stay, with NULL attributes."""
    return orders.join(customers, on=["customer_id", "customer_name"], how="left")


def with_order_time(orders: DataFrame, col: str = "order_datetime") -> DataFrame:
    """Add `order_datetime_ts` and `order_date` from epoch seconds held as text."""
    return (orders.withColumn("order_datetime_ts", epoch_to_timestamp(col))
            .withColumn("order_date", F.to_date("order_datetime_ts")))


def explode_orders(orders: DataFrame, keep: Sequence[str], items: str = "ordered_products",
                   outer: bool = False) -> DataFrame:
    """One row per ordered product, with its line total.

    Orders whose array is empty or NULL vanish, or with `outer` stay as a row of NULL product.
    """
    unnest = F.explode_outer if outer else F.explode
    product = orders.select(*keep, unnest(items).alias("_p"))
    return product.select(
        *keep,
        F.col("_p.name").alias("product_name"),
        F.col("_p.price").alias("price"),
        F.col("_p.qty").alias("quantity"),
        (F.col("_p.price") * F.col("_p.qty")).alias("line_total"),
    )


def orders_with_item_over(orders: DataFrame, price: float,
                          items: str = "ordered_products") -> DataFrame:
    """Order records holding at least one product dearer than `price`, without unnesting them."""
    return orders.where(F.exists(items, lambda p: p["price"] > price))


def empty_arrays(orders: DataFrame, items: str = "ordered_products") -> DataFrame:
    """Order records whose array is empty or NULL."""
    return orders.where(F.coalesce(F.size(items), F.lit(0)) <= 0)
