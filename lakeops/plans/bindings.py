"""The retail tables of the operators, built from the star-schema test tables.

Money is DECIMAL(12,2): sums are exact and do not depend on the order of addition, so results are
the same on any number of executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeops.operators.orders import nest_lines
from lakeops.session import path_bytes, scratch_dir, tune
from lakeops.streaming.io import read_stream

MONEY = "decimal(12,2)"


def money(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast(MONEY)


def ntz(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("timestamp_ntz")


def as_double(df: DataFrame) -> DataFrame:
    """Hand decimals back as doubles and big decimals of whole numbers untouched."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("double").alias(f.name)
        if f.dataType.typeName() == "decimal" else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


class Tables:
    """Lazy readers of the test tables and the logical inputs derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")
        self.sizes: dict[str, int] = {}

    def read(self, name: str) -> DataFrame:
        """A table; shuffles are sized for all tables read so far."""
        if name not in self.sizes:
            self.sizes[name] = path_bytes(self.spark, f"{self.dir}/{name}.parquet")
            tune(self.spark, sum(self.sizes.values()))
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def scratch(self, name: str) -> str:
        return scratch_dir(self.spark, name)

    # ---- dimensions -------------------------------------------------------------------------

    def customers(self) -> DataFrame:
        """customer_id, customer_name, state, city, loyalty_segment."""
        places = (self.read("nation").join(self.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
                  .select(F.col("n_nationkey"), F.col("n_name").alias("state"), F.col("r_name").alias("city")))
        return (self.read("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
                .select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
                        "state", "city", F.col("c_mktsegment").alias("loyalty_segment")))

    # ---- orders -----------------------------------------------------------------------------

    def order_heads(self) -> DataFrame:
        """Orders without lines: order_number, order_datetime (epoch text), customer_id, customer_name."""
        names = self.read("customer").select("c_custkey", F.col("c_name").alias("customer_name"))
        epoch = F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).cast("string")
        return (self.read("orders").join(names, F.col("o_custkey") == F.col("c_custkey"))
                .select(F.col("o_orderkey").alias("order_number"), epoch.alias("order_datetime"),
                        F.col("o_custkey").alias("customer_id"), "customer_name"))

    def priced_lines(self) -> DataFrame:
        """Order lines with their product: order_number, product_name, price, quantity."""
        lines = self.read("lineitem").withColumn("line_place", F.monotonically_increasing_id())
        parts = self.read("part").select("p_partkey", F.col("p_name").alias("product_name"),
                                         money("p_retailprice").alias("price"))
        return (lines.select(F.col("l_orderkey").alias("order_number"), "l_partkey",
                             F.col("l_quantity").cast("int").alias("quantity"), "line_place")
                .join(parts, F.col("l_partkey") == F.col("p_partkey"))
                .select("order_number", "product_name", "price", "quantity", "line_place"))

    def sales_orders(self) -> DataFrame:
        """Nested orders; an order without lines has an empty array."""
        item = F.struct(F.col("product_name").alias("name"), "price", F.col("quantity").alias("qty"))
        keys = self.read("lineitem").select(F.col("l_orderkey").alias("order_number"))
        nested = nest_lines(self.priced_lines(), "order_number", item, "ordered_products",
                            place="line_place", keys=keys)
        empty = F.array().cast(nested.schema["ordered_products"].dataType)
        return (self.order_heads().join(nested, "order_number", "left")
                .select("order_number", F.coalesce("record_no", F.lit(0)).alias("record_no"),
                        "order_datetime", "customer_id", "customer_name",
                        F.coalesce("ordered_products", empty).alias("ordered_products")))

    def flat_orders(self) -> DataFrame:
        """One row per order line with order, customer and product attributes.

        The same rows as nesting, enriching and exploding, without gathering any array.
        """
        orders = (self.read("orders").join(self.customers(), F.col("o_custkey") == F.col("customer_id"))
                  .select(F.col("o_orderkey").alias("order_number"), "customer_id", "customer_name",
                          F.col("o_orderdate").alias("order_datetime_ts"),
                          F.to_date("o_orderdate").alias("order_date"),
                          "state", "city", "loyalty_segment"))
        return (self.priced_lines().drop("line_place").join(orders, "order_number")
                .withColumn("line_total", (F.col("price") * F.col("quantity")).cast("decimal(16,2)")))

    def keyed_orders(self) -> DataFrame:
        """One row per order, for the operators that need a key."""
        return (self.read("orders").join(self.customers(), F.col("o_custkey") == F.col("customer_id"))
                .select(F.col("o_orderkey").alias("order_number"), "customer_id", "customer_name",
                        F.col("o_orderdate").alias("order_datetime_ts"), "state", "loyalty_segment",
                        F.col("o_orderstatus").alias("status"), money("o_totalprice").alias("line_total")))

    def loans(self) -> DataFrame:
        """Loan-like rows from orders; NULLs where an order has no lines, violations as the data has them."""
        price = F.col("l_extendedprice")
        lines = self.read("lineitem").groupBy("l_orderkey").agg(
            money(F.max(price)).alias("funded_amnt"),
            money(F.max(F.when(F.col("l_returnflag") == "R", price).otherwise(0.0))).alias("paid_amnt"),
            (F.max("l_discount").cast("decimal(12,4)") * 500).cast("decimal(12,2)").alias("int_rate"),
            (F.max("l_tax").cast("decimal(12,4)") * 100).cast("decimal(12,2)").alias("dti"),
        )
        people = (self.read("customer").join(self.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
                  .select("c_custkey", F.col("n_name").alias("addr_state"),
                          money("c_acctbal").alias("annual_inc")))
        return (self.read("orders").join(people, F.col("o_custkey") == F.col("c_custkey"))
                .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
                .select(F.col("o_orderkey").alias("loan_id"), money("o_totalprice").alias("loan_amnt"),
                        "funded_amnt", "paid_amnt", "addr_state", "annual_inc",
                        F.col("o_orderpriority").alias("term"), F.col("o_orderstatus").alias("grade"),
                        "int_rate", "dti", F.col("o_orderdate").alias("created_at")))

    # ---- events -----------------------------------------------------------------------------

    def events(self) -> DataFrame:
        """The event stream as a batch: event_id, event_time, user_id, state, line_total."""
        return order_events(self.read("events"))

    def stream_path(self, name: str) -> str:
        """A pattern that a file stream takes, be the table one file or a directory of files."""
        return f"{self.dir}/{name}.parque[t]"

    def event_stream(self) -> DataFrame:
        """The events as a stream.

        All that is there makes one micro-batch: files need not be in time order, so in several
        batches rows could come later than the watermark allows.
        """
        schema = self.read("events").schema
        return order_events(read_stream(self.spark, self.stream_path("events"), schema, fmt="parquet"))


def order_events(events: DataFrame) -> DataFrame:
    return events.select("event_id", F.col("ts").cast("timestamp").alias("event_time"), "user_id",
                         F.col("event_type").alias("state"), money("value").alias("line_total"))
