"""Feature operators and the base table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.catalog.registry import query
from reviewlab.catalog.roles_sql import (
    BASE,
    PRODUCT_MEASURES,
    ROUNDED,
    with_roles,
)
from reviewlab.functions.expressions import elapsed_days
from reviewlab.operators import cleaning as cl
from reviewlab.operators import features as ft
from reviewlab.plans import base_table as bt
from reviewlab.plans import state as st
from reviewlab.session import scratch_path
from reviewlab.sources import adapters as A


def rounded(df: DataFrame) -> DataFrame:
    """Fixed decimals for the columns whose sum depends on the order of addition."""
    return df.withColumns({c: F.round(c, d) for c, d in ROUNDED.items() if c in df.columns})


# -- products, orders, items ------------------------------------------------------------------


@query(
    "product_features",
    with_roles("products", "product_features") + "select * from product_features",
)
def product_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.product_features(A.products(spark, sf_dir))


@query(
    "delivery_features",
    with_roles("purchases")
    + """select order_id,
         cast(date_diff('day', order_purchase_timestamp, order_delivered_customer_date)
             as integer) as delivery_duration,
         cast(date_diff('day', order_purchase_timestamp, order_approved_at) as integer)
             as approval_duration,
         cast(date_diff('day', order_delivered_customer_date, order_estimated_delivery_date)
             as integer) as delivery_delay
         from purchases""",
)
def delivery_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    featured = ft.delivery_features(A.orders(spark, sf_dir))
    return featured.select("order_id", "delivery_duration", "approval_duration", "delivery_delay")


@query(
    "customer_history",
    with_roles("purchases", "clean_purchases", "history") + "select * from history",
)
def customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.customer_history(bt.clean_orders(A.orders(spark, sf_dir)))


@query(
    "recency",
    with_roles("purchases")
    + """select customer_id, max(order_purchase_timestamp) as last_order_date,
         cast(date_diff('day', max(order_purchase_timestamp), date '2002-01-01') as integer)
             as recency
         from purchases group by customer_id""",
)
def recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = A.orders(spark, sf_dir).groupBy("customer_id")
    last = last.agg(F.max("order_purchase_timestamp").alias("last_order_date"))
    return ft.recency(last, "last_order_date", "2002-01-01")


@query(
    "orders_with_history",
    with_roles("purchases", "clean_purchases", "history", "order_side")
    + """select order_id, customer_id, order_count, first_order_date, last_order_date, recency,
         is_repeated_customer from order_side""",
)
def orders_with_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ft.with_customer_history(bt.clean_orders(A.orders(spark, sf_dir)))
    return joined.select(
        "order_id",
        "customer_id",
        "order_count",
        "first_order_date",
        "last_order_date",
        "recency",
        "is_repeated_customer",
    )


# An earlier slice of the orders, as it might be scored long after training.
SLICE = "order_purchase_timestamp < timestamp '1998-01-01'"


def _state(spark: SparkSession, orders: DataFrame) -> st.FeatureState:
    """Learnt, saved and loaded again."""
    path = scratch_path(spark, "state")
    st.learn(bt.clean_orders(orders)).save(path)
    return st.load(spark, path)


@query(
    "feature_state",
    with_roles("purchases", "clean_purchases", "history")
    + """select customer_id, order_count, first_order_date, last_order_date,
         (select max(order_purchase_timestamp) from clean_purchases) as as_of from history""",
)
def feature_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _state(spark, A.orders(spark, sf_dir))
    return state.history.withColumn("as_of", F.lit(state.as_of))


@query(
    "scored_slice",
    with_roles("purchases", "clean_purchases", "history", "order_side")
    + f"""select order_id, customer_id, order_count, first_order_date, last_order_date, recency,
         is_repeated_customer from order_side where {SLICE}""",
)
def scored_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of an earlier time, scored alone, have the features they had in training."""
    orders = A.orders(spark, sf_dir)
    side = bt.order_side(orders.filter(SLICE), state=_state(spark, orders))
    return side.select(
        "order_id",
        "customer_id",
        "order_count",
        "first_order_date",
        "last_order_date",
        "recency",
        "is_repeated_customer",
    )


@query(
    "scored_later_orders",
    with_roles("purchases", "clean_purchases", "history")
    + f"""select order_id, h.order_count, h.last_order_date,
         cast(date_diff('day', h.last_order_date, (select max(order_purchase_timestamp)
              from clean_purchases where {SLICE})) as integer) as recency,
         case when h.order_count > 1 then 1 else 0 end as is_repeated_customer
         from clean_purchases join history h using (customer_id) where not {SLICE}""",
)
def scored_later_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders bought after training add to their customers' history."""
    orders = A.orders(spark, sf_dir)
    state = _state(spark, orders.filter(SLICE))
    side = bt.order_side(orders.filter(f"not {SLICE}"), state=state)
    return side.select("order_id", "order_count", "last_order_date", "recency", "is_repeated_customer")


@query(
    "item_features",
    with_roles("items", "item_features")
    + """select order_id, order_item_id, product_id, price, shipping_cost, item_total_cost,
         shipping_to_price_ratio from item_features""",
)
def item_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.item_features(A.items(spark, sf_dir))


@query(
    "item_order_agg",
    with_roles("items", "item_features", "one_product", "item_agg")
    + "select * from item_agg join one_product using (order_id)",
)
def item_order_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ft.item_order_agg(ft.item_features(A.items(spark, sf_dir))))


@query("representative_product", with_roles("items", "one_product") + "select * from one_product")
def representative_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = A.items(spark, sf_dir)
    return lines.groupBy("order_id").agg(ft.representative_product().alias("product_id"))


@query(
    "item_product_agg",
    with_roles("products", "product_features", "clean_products", "items")
    + f"select order_id, {PRODUCT_MEASURES} from items join clean_products using (product_id) "
    + "group by order_id",
)
def item_product_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = bt.clean_products(A.products(spark, sf_dir))
    return rounded(ft.item_product_agg(A.items(spark, sf_dir), products))


@query(
    "item_product_single",
    with_roles("products", "product_features", "clean_products", "items", "one_product")
    + f"select order_id, {PRODUCT_MEASURES} from one_product join clean_products "
    + "using (product_id) group by order_id",
)
def item_product_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = bt.clean_products(A.products(spark, sf_dir))
    return rounded(ft.item_product_agg(A.items(spark, sf_dir), products, representative=True))


@query(
    "order_item_profile",
    with_roles(
        "products", "product_features", "clean_products", "items", "item_features", "item_profile"
    )
    + "select * from item_profile",
)
def order_item_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    # product columns of an order without a known product are null, and its category text empty
    products = bt.clean_products(A.products(spark, sf_dir))
    profile = rounded(ft.order_item_profile(A.items(spark, sf_dir), products))
    return profile.withColumn("category", F.nullif("category", F.lit("")))


# -- payments ---------------------------------------------------------------------------------


@query(
    "payment_features",
    with_roles("payments", "payment_features") + "select * from payment_features",
)
def payment_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.payment_features(A.payments(spark, sf_dir))


@query(
    "one_hot",
    with_roles("payments")
    + """select order_id, payment_sequential, payment_type,
         case when payment_type = 'A' then 1 else 0 end as "dummy_A",
         case when payment_type = 'N' then 1 else 0 end as "dummy_N",
         case when payment_type = 'R' then 1 else 0 end as "dummy_R" from payments""",
)
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.payments(spark, sf_dir).select("order_id", "payment_sequential", "payment_type")
    return ft.one_hot(rows, "payment_type")


@query(
    "payments_with_total",
    with_roles("payments", "order_totals")
    + "select p.*, monetary_value from payments p left join order_totals using (order_id)",
)
def payments_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.with_order_total(A.payments(spark, sf_dir))


@query("payment_order_agg", with_roles("payments", "payment_agg") + "select * from payment_agg")
def payment_order_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.payment_order_agg(A.payments(spark, sf_dir), A.PAYMENT_TYPES)


@query("order_totals", with_roles("payments", "order_totals") + "select * from order_totals")
def order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.order_totals(A.payments(spark, sf_dir))


# -- reviews ----------------------------------------------------------------------------------

RESPONSIVENESS = """cast((epoch_us(review_answer_timestamp) - epoch_us(review_creation_date))
    // 1000000 as double) / 86400 as review_responsiveness"""


@query(
    "binary_label",
    """select o_orderkey, case when substr(o_orderpriority, 1, 1) = '3' then null
              when cast(substr(o_orderpriority, 1, 1) as integer) >= 4 then 1 else 0 end as review
       from orders""",
)
def binary_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score 3 is made null, and stays null in the label."""
    digit = F.substring("o_orderpriority", 1, 1)
    scored = A.load(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif(digit, F.lit("3")).cast("int").alias("review_score")
    )
    return ft.binary_label(scored)


@query(
    "review_responsiveness",
    with_roles("visits") + f"select review_id, order_id, {RESPONSIVENESS} from visits",
)
def review_responsiveness(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = elapsed_days("review_answer_timestamp", "review_creation_date")
    return A.visit_reviews(spark, sf_dir).select(
        "review_id", "order_id", days.alias("review_responsiveness")
    )


@query(
    "latest_per_key",
    with_roles("visits")
    + """select * exclude (place) from (select *, row_number() over (partition by order_id
             order by review_answer_timestamp desc, review_id desc) as place from visits)
         where place = 1""",
)
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.visit_reviews(spark, sf_dir)
    return cl.latest_per_key(rows, "order_id", "review_answer_timestamp", "review_id")


@query(
    "latest_timestamp",
    with_roles("visits")
    + """select order_id, max(review_answer_timestamp) as latest_timestamp
         from visits group by order_id""",
)
def latest_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.visit_reviews(spark, sf_dir)
    return rows.groupBy("order_id").agg(F.max("review_answer_timestamp").alias("latest_timestamp"))


@query(
    "reviews_with_latest",
    with_roles("visits")
    + """select v.*, max(review_answer_timestamp) over (partition by order_id)
         as latest_timestamp from visits v""",
)
def reviews_with_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.with_latest_timestamp(A.visit_reviews(spark, sf_dir))


@query(
    "review_features",
    with_roles("visits")
    + f"""select * exclude (place) from (select order_id, review_id, review_creation_date,
             review_answer_timestamp, review_answer_timestamp as latest_timestamp,
             case when review_score >= 4 then 1 else 0 end as review, {RESPONSIVENESS},
             row_number() over (partition by order_id
                 order by review_answer_timestamp desc, review_id desc) as place from visits)
         where place = 1""",
)
def review_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.latest_review(A.visit_reviews(spark, sf_dir))


# -- base table -------------------------------------------------------------------------------

ORDER_COLUMNS = """order_id, order_count, first_order_date, last_order_date, recency,
    is_repeated_customer, delivery_duration, approval_duration"""
ITEM_COLUMNS = "i.* exclude (order_id)"
PAYMENT_COLUMNS = "p.* exclude (order_id)"
# orders whose products are all unknown have no product features and drop out
COMPLETE = "where i.total_product_density is not null"


@query(
    "base_table",
    with_roles(*BASE)
    + f"""select {ORDER_COLUMNS}, {ITEM_COLUMNS}, {PAYMENT_COLUMNS},
          total_payment_value as monetary_value, review, latest_timestamp
          from order_side join item_profile i using (order_id) join payment_agg p using (order_id)
          join labels_by_order using (order_id) {COMPLETE}""",
)
def base_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = A.tables(spark, sf_dir)
    return rounded(bt.build_base_table(tables, payment_types=A.PAYMENT_TYPES))


@query(
    "base_table_scoring",
    with_roles(*BASE)
    + f"""select {ORDER_COLUMNS}, {ITEM_COLUMNS}, {PAYMENT_COLUMNS},
          total_payment_value as monetary_value
          from order_side join item_profile i using (order_id) join payment_agg p using (order_id)
          {COMPLETE}""",
)
def base_table_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = A.tables(spark, sf_dir, labelled=False)
    return rounded(bt.build_base_table(tables, payment_types=A.PAYMENT_TYPES))


@query(
    "base_table_row_grain",
    with_roles(*BASE, "payment_features", "order_totals")
    + f"""select {ORDER_COLUMNS}, {ITEM_COLUMNS}, payment_sequential, payment_type, payment_value,
          installment_value, monetary_value,
          case when payment_type = 'A' then 1 else 0 end as "dummy_A",
          case when payment_type = 'N' then 1 else 0 end as "dummy_N",
          case when payment_type = 'R' then 1 else 0 end as "dummy_R",
          review, latest_timestamp
          from order_side join item_profile i using (order_id)
          join (select distinct * from payment_features join order_totals using (order_id)
                where installment_value is not null) using (order_id)
          join labels_by_order using (order_id) {COMPLETE}""",
)
def base_table_row_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per payment that has installments."""
    tables = A.tables(spark, sf_dir)
    base = bt.build_base_table(tables, payment_types=A.PAYMENT_TYPES, payment_grain="row")
    return rounded(base)


@query(
    "base_table_single_product",
    with_roles(*BASE, "one_product", "item_agg")
    + f"""select {ORDER_COLUMNS}, i.* exclude (order_id), g.* exclude (order_id),
          {PAYMENT_COLUMNS}, total_payment_value as monetary_value, review, latest_timestamp
          from order_side join item_agg g using (order_id)
          join (select order_id, {PRODUCT_MEASURES} from one_product
                join clean_products using (product_id) group by order_id) i using (order_id)
          join payment_agg p using (order_id) join labels_by_order using (order_id)""",
)
def base_table_single_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product stands for each order."""
    tables = A.tables(spark, sf_dir)
    base = bt.build_base_table(
        tables, payment_types=A.PAYMENT_TYPES, representative_product=True
    )
    return rounded(base)
