"""The star-schema test tables in the five roles of the library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.sources.tables import Tables


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length("p_brand").alias("product_description_lenght"),
        (size % 6).alias("product_photos_qty"),
        F.nullif(size % 11, F.lit(0)).cast("double").alias("product_weight_g"),
        size.cast("double").alias("product_length_cm"),
        (size % 7 + 1).cast("double").alias("product_width_cm"),
        (size % 5 + 1).cast("double").alias("product_height_cm"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    def later(unit: str, modulus: int):
        return F.timestamp_add(unit, (F.col("o_orderkey") % modulus).cast("int"), "o_orderdate")

    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        later("HOUR", 72).alias("order_approved_at"),
        later("DAY", 5).alias("order_delivered_carrier_date"),
        F.when(F.col("o_orderstatus") != "P", later("DAY", 30)).alias(
            "order_delivered_customer_date"
        ),
        F.timestamp_add("DAY", F.lit(15), "o_orderdate").alias("order_estimated_delivery_date"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    # cents times percent, so the product is exact before it is divided once
    shipping = F.rint(F.col("l_extendedprice") * 100) * F.rint(F.col("l_tax") * 100) / 10000
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("price"),
        shipping.alias("shipping_cost"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.col("l_returnflag").alias("payment_type"),
        F.rint(F.col("l_discount") * 100).cast("int").alias("payment_installments"),
        F.col("l_extendedprice").alias("payment_value"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("review_id"),
        F.col("o_orderkey").alias("order_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("review_score"),
        F.col("o_orderdate").alias("review_creation_date"),
        F.timestamp_add("DAY", (F.col("o_orderkey") % 5).cast("int"), "o_orderdate").alias(
            "review_answer_timestamp"
        ),
    )


def visit_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many scores per key, for the operators that keep the latest one."""
    return load(spark, sf_dir, "events").select(
        F.col("event_id").alias("review_id"),
        F.col("user_id").alias("order_id"),
        (F.floor("value").cast("int") % 5 + 1).alias("review_score"),
        F.col("ts").alias("review_creation_date"),
        F.timestamp_add("HOUR", (F.col("event_id") % 48).cast("int"), "ts").alias(
            "review_answer_timestamp"
        ),
    )


def tables(spark: SparkSession, sf_dir: str, labelled: bool = True) -> Tables:
    return Tables(
        products=products(spark, sf_dir),
        orders=orders(spark, sf_dir),
        items=items(spark, sf_dir),
        payments=payments(spark, sf_dir),
        reviews=reviews(spark, sf_dir) if labelled else None,
    )


# The payment types found in this data.
PAYMENT_TYPES = ["A", "N", "R"]
