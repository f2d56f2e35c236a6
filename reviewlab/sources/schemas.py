"""Declared schemas of the five input tables.

Declaring them saves the extra scan type inference needs, and gives the training and the
scoring files the same types.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Table and column names of the input files (spelling as in the files).
PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("product_category_name", T.StringType()),
        T.StructField("product_name_lenght", T.IntegerType()),
        T.StructField("product_description_lenght", T.IntegerType()),
        T.StructField("product_photos_qty", T.IntegerType()),
        T.StructField("product_weight_g", T.DoubleType()),
        T.StructField("product_length_cm", T.DoubleType()),
        T.StructField("product_height_cm", T.DoubleType()),
        T.StructField("product_width_cm", T.DoubleType()),
    ]
)
ORDERS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("order_status", T.StringType()),
        T.StructField("order_purchase_timestamp", T.TimestampNTZType()),
        T.StructField("order_approved_at", T.TimestampNTZType()),
        T.StructField("order_delivered_carrier_date", T.TimestampNTZType()),
        T.StructField("order_delivered_customer_date", T.TimestampNTZType()),
        T.StructField("order_estimated_delivery_date", T.TimestampNTZType()),
    ]
)
ITEMS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("order_item_id", T.IntegerType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("shipping_cost", T.DoubleType()),
    ]
)
PAYMENTS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("payment_sequential", T.IntegerType()),
        T.StructField("payment_type", T.StringType()),
        T.StructField("payment_installments", T.IntegerType()),
        T.StructField("payment_value", T.DoubleType()),
    ]
)
REVIEWS = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("review_score", T.IntegerType()),
        T.StructField("review_creation_date", T.TimestampNTZType()),
        T.StructField("review_answer_timestamp", T.TimestampNTZType()),
    ]
)
SCHEMAS = {
    "products": PRODUCTS,
    "orders": ORDERS,
    "items": ITEMS,
    "payments": PAYMENTS,
    "reviews": REVIEWS,
}

# Text form of every timestamp, and the timestamp columns of each table.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
ORDER_TIMESTAMPS = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]
REVIEW_TIMESTAMPS = ["review_creation_date", "review_answer_timestamp"]
