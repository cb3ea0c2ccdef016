"""File sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    ArrayType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# The nested sales-order schema. Money is decimal here, so that sums are exact.
PRODUCT = StructType([
    StructField("name", StringType()),
    StructField("price", DecimalType(12, 2)),
    StructField("qty", IntegerType()),
])
SALES_ORDER = StructType([
    StructField("order_number", LongType()),
    StructField("record_no", LongType()),
    StructField("order_datetime", StringType()),
    StructField("customer_id", LongType()),
    StructField("customer_name", StringType()),
    StructField("ordered_products", ArrayType(PRODUCT)),
])


def read_json(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """JSON lines. Without a schema one is inferred, by an extra pass; with one, missing fields are NULL."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; every column is a string."""
    return spark.read.option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Parquet; `merge_schema` unites the columns of files written before and after columns were added."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    """Write parquet to a path, partitioned by low-cardinality columns where given."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
