"""The base table: one row per order with every feature, for training or for scoring."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.functions.expressions import MONEY_SCALE
from reviewlab.operators import features as ft
from reviewlab.operators.cleaning import (
    drop_columns,
    drop_duplicates,
    drop_nulls,
    one_per_key,
    parse_timestamps,
)
from reviewlab.operators.joins import attach
from reviewlab.plans.state import FeatureState
from reviewlab.sources.schemas import ORDER_TIMESTAMPS, REVIEW_TIMESTAMPS
from reviewlab.sources.tables import Tables

# Columns that serve the features and are no features themselves.
HELPER_COLUMNS = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "payment_installments",
    "review_creation_date",
    "review_answer_timestamp",
    "product_id",
    "customer_id",
    "order_status",
    "review_id",
    "review_responsiveness",
    "delivery_delay",
    "dummy_not_defined",
]


def clean_products(products: DataFrame) -> DataFrame:
    return one_per_key(drop_nulls(ft.product_features(products)), "product_id")


def clean_orders(orders: DataFrame) -> DataFrame:
    return one_per_key(drop_nulls(parse_timestamps(orders, ORDER_TIMESTAMPS)), "order_id")


def order_side(
    orders: DataFrame,
    as_of=None,
    history: DataFrame | None = None,
    state: FeatureState | None = None,
) -> DataFrame:
    cleaned = clean_orders(orders)
    if state is not None:
        history = state.history_of(cleaned)
    return ft.delivery_features(ft.with_customer_history(cleaned, as_of, history))


def payment_rows(payments: DataFrame, types: Iterable[str]) -> DataFrame:
    """Complete payments one by one with their flags, for the row-grain base table."""
    # what is derived from a row is equal for equal rows, so it need not be moved to find them
    rows = drop_duplicates(drop_nulls(payments))
    return drop_nulls(ft.one_hot(ft.payment_features(rows), "payment_type", types))


def build_base_table(
    tables: Tables,
    as_of=None,
    payment_types: Sequence[str] = ft.PAYMENT_TYPES,
    payment_grain: str = "order",
    representative_product: bool = False,
    history: DataFrame | None = None,
    keep_helpers: bool = False,
    money_scale: int | None = MONEY_SCALE,
    state: FeatureState | None = None,
) -> DataFrame:
    """Join orders to their items, payments and (for training) last review; drop incomplete rows.

    Every side is reduced to one row per order before the join, so no join can multiply rows.
    ``payment_grain="row"`` keeps one row per payment instead, and ``representative_product``
    describes an order by one product. ``keep_helpers`` leaves the columns that the correlation
    report needs and the models must not see.

    ``state`` holds the customers' history that a model was trained with (``plans.state``); a table
    to be scored takes it, so that the same order has the same features in both.

    There is one row per order id and per product id, and incomplete items and payments are left
    out before they are summed, so repeated keys and NaN amounts change no other order.
    """
    if payment_grain not in ("order", "row"):
        raise ValueError(f"payment_grain must be 'order' or 'row', not {payment_grain!r}")
    base = order_side(tables.orders, as_of, history, state)
    profile = ft.order_item_profile(
        drop_nulls(tables.items),
        clean_products(tables.products),
        representative_product,
        money_scale,
    )
    base = base.join(drop_nulls(profile), "order_id", "left")
    if tables.reviews is not None:
        reviews = parse_timestamps(tables.reviews, REVIEW_TIMESTAMPS)
        base = base.join(drop_nulls(ft.latest_review(reviews)), "order_id", "left")
    if payment_grain == "order":
        complete = drop_nulls(tables.payments)
        payments = ft.payment_order_agg(complete, payment_types, money_scale)
        payments = payments.withColumn("monetary_value", F.col("total_payment_value"))
        base = base.join(payments, "order_id", "left")
    else:
        # the total joins at order grain, so that the payments are moved for one join only
        base = base.join(ft.order_totals(tables.payments, money_scale), "order_id", "left")
        base = attach(
            payment_rows(tables.payments, payment_types),
            base,
            "order_id",
            # an order may own very many payments: they are the detail side of a salted join
            spread=["payment_sequential", "payment_value"],
            counts=tables.payments.groupBy("order_id").agg(F.count(F.lit(1)).alias("payments")),
            n="payments",
            how="inner",
        )
    base = drop_nulls(base)
    return base if keep_helpers else drop_columns(base, HELPER_COLUMNS)
