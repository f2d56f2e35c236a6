"""Scans, sinks, schema and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlab.catalog.registry import query
from reviewlab.catalog.roles_sql import with_roles
from reviewlab.functions.expressions import money_total
from reviewlab.operators import profiling as pr
from reviewlab.operators.joins import attach
from reviewlab.session import scratch_path
from reviewlab.sources import adapters as A
from reviewlab.sources.schemas import ORDERS
from reviewlab.sources.tables import export_predictions, read_table, write_table


@query(
    "scan_roundtrip",
    with_roles("purchases")
    + """select cast(order_id as varchar) as order_id, cast(customer_id as varchar) as customer_id,
         order_status, order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
         order_delivered_customer_date, order_estimated_delivery_date from purchases""",
)
def scan_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV and read back with the declared schema, nulls included."""
    path = scratch_path(spark, "orders-csv")
    write_table(A.orders(spark, sf_dir), path, fmt="csv")
    return read_table(spark, path, ORDERS)


@query("scan_parquet", "select l_orderkey, l_linenumber, l_extendedprice from lineitem")
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, f"{sf_dir}/lineitem.parquet", fmt="parquet")
    return table.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "export_roundtrip",
    """select o_orderkey as order_id,
              case when o_totalprice > 200000 then 1.0::double else 0.0::double end as prediction
       from orders""",
)
def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV export of (key, prediction), read back."""
    rows = A.load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_totalprice") > 200000, 1.0).otherwise(0.0).alias("prediction"),
    )
    path = scratch_path(spark, "predictions-csv")
    export_predictions(rows, path)
    schema = T.StructType(
        [T.StructField("order_id", T.LongType()), T.StructField("prediction", T.DoubleType())]
    )
    return read_table(spark, path, schema)


# The columns of the items table with Spark's names for their types.
ITEM_TYPES = {
    "order_id": "bigint",
    "order_item_id": "int",
    "product_id": "bigint",
    "price": "double",
    "shipping_cost": "double",
}


@query(
    "schema_report",
    with_roles("items")
    + " union all ".join(
        f"""select {i} as position, '{c}' as "column", '{t}' as type,
            count(*) as "rows", count({c}) as filled from items"""
        for i, (c, t) in enumerate(ITEM_TYPES.items())
    ),
)
def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.schema_report(A.items(spark, sf_dir))


@query(
    "preview",
    """select l_orderkey, l_linenumber, l_partkey, l_extendedprice from lineitem
       order by l_orderkey, l_linenumber, l_partkey, l_extendedprice limit 20""",
)
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.load(spark, sf_dir, "lineitem")
    return pr.preview(rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"))


@query(
    "sorted_report",
    """select o_custkey, o_orderkey, o_totalprice from orders
       order by o_totalprice desc, o_orderkey""",
)
def sorted_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return pr.sorted_report(rows, "o_totalprice", ["o_orderkey"])


@query(
    "sort_by_key",
    with_roles("payments") + "select * from payments order by order_id, payment_sequential",
)
def sort_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.payments(spark, sf_dir)
    tie_break = ["payment_sequential", "payment_type", "payment_installments", "payment_value"]
    return pr.sorted_report(rows, "order_id", tie_break, descending=False)


@query(
    "top_k",
    """select p_type, p_brand, cast(sum(cast(l_extendedprice as decimal(12,2))) as double)
              as revenue
       from lineitem join part on l_partkey = p_partkey
       group by p_type, p_brand order by revenue desc, p_type, p_brand limit 10""",
)
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = A.load(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_extendedprice"
    )
    parts = A.load(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    joined = attach(lines, parts, "p_partkey", ["l_orderkey"], how="inner")
    revenue = joined.groupBy("p_type", "p_brand").agg(
        money_total("l_extendedprice").alias("revenue")
    )
    return pr.top_k(revenue, "revenue", 10, ["p_type", "p_brand"])
