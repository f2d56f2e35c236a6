"""Product, order, item, payment and review features.

Each function takes and returns a DataFrame and is used unchanged for the training and for the
scoring set. Per-order tables are plain grouped aggregates, so partial results are formed before
the shuffle; only ``order_item_profile`` moves an order's lines, which are slimmer, to one place.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.functions.expressions import (
    MONEY_SCALE,
    at_least,
    days_between,
    elapsed_days,
    flag,
    joined_set,
    money_mean,
    money_total,
    ratio,
)
from reviewlab.operators.cleaning import drop_nulls, latest_per_key
from reviewlab.operators.joins import attach

# Payment types that get a flag of their own.
PAYMENT_TYPES = ["mobile", "credit_card", "voucher", "debit_card"]
# Flags become columns, so a list learnt from data must stay a short one.


# -- products ---------------------------------------------------------------------------------


def product_features(products: DataFrame) -> DataFrame:
    """Volume, volume per gram and grams per volume; null where the divisor is zero."""
    volume = F.col("product_length_cm") * F.col("product_width_cm") * F.col("product_height_cm")
    return products.select(
        "*",
        volume.alias("product_volume"),
        ratio(volume, "product_weight_g").alias("size_to_weight_ratio"),
        ratio("product_weight_g", volume).alias("product_density"),
    )


# -- orders -----------------------------------------------------------------------------------


def delivery_features(orders: DataFrame) -> DataFrame:
    """Days to delivery, days to approval, and days the delivery came before its estimate."""
    purchased = "order_purchase_timestamp"
    delivered = "order_delivered_customer_date"
    return orders.select(
        "*",
        days_between(delivered, purchased).alias("delivery_duration"),
        days_between("order_approved_at", purchased).alias("approval_duration"),
        days_between("order_estimated_delivery_date", delivered).alias("delivery_delay"),
    )


def recency(df: DataFrame, last_date: str, as_of) -> DataFrame:
    """Days from ``last_date`` to ``as_of`` (a date, a date text, or a column)."""
    day = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    return df.withColumn("recency", days_between(day, last_date))


def customer_history(orders: DataFrame, as_of=None) -> DataFrame:
    """Per customer: number of orders, first and last purchase, days since the last one.

    ``as_of`` fixes the day the recency is counted to. By default it is the last purchase in
    the data, so that a later run gives the same numbers.
    """
    bought = "order_purchase_timestamp"
    if as_of is None:
        as_of = orders.agg(F.max(bought)).scalar()
    history = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("order_count"),
        F.min(bought).alias("first_order_date"),
        F.max(bought).alias("last_order_date"),
    )
    return recency(history, "last_order_date", as_of)


def with_customer_history(
    orders: DataFrame, as_of=None, history: DataFrame | None = None
) -> DataFrame:
    """Add the customer's history and the repeat-customer flag to every order.

    ``history`` may come from a longer period than ``orders``, such as the training and the
    scoring set together.
    """
    if history is None:
        history = customer_history(orders, as_of)
    joined = attach(
        orders, history, "customer_id", spread=["order_id"], counts=history, n="order_count"
    )
    return joined.withColumn("is_repeated_customer", flag(F.col("order_count") > 1))


# -- items ------------------------------------------------------------------------------------

ITEM_INPUTS = ["order_id", "order_item_id", "product_id", "price", "shipping_cost"]
ITEM_MEASURES = ["price", "shipping_cost", "item_total_cost", "shipping_to_price_ratio"]


def item_features(items: DataFrame) -> DataFrame:
    """Cost with shipping, and shipping as a share of the price."""
    return items.select(
        "*",
        (F.col("price") + F.col("shipping_cost")).alias("item_total_cost"),
        ratio("shipping_cost", "price").alias("shipping_to_price_ratio"),
    )


def _item_aggregates(money_scale: int | None) -> list[Column]:
    out = [F.count("order_item_id").alias("nbr_items")]
    for m in ITEM_MEASURES:
        # the ratio is no amount of money: it is summed as the double it is
        scale = None if m.endswith("ratio") else money_scale
        out += [
            F.min(m).alias(f"min_{m}"),
            F.max(m).alias(f"max_{m}"),
            money_mean(m, scale).alias(f"avg_{m}"),
            money_total(m, scale).alias(f"total_{m}"),
        ]
    return out


def representative_product() -> Column:
    """The product of the line with the lowest item number (lowest product id on a tie)."""
    return F.min(F.struct("order_item_id", "product_id")).getField("product_id")


def item_order_agg(
    items: DataFrame, product: bool = True, money_scale: int | None = MONEY_SCALE
) -> DataFrame:
    """Per order: number of items, one product, and min, max, mean and total of each measure."""
    aggregates = _item_aggregates(money_scale)
    if product:
        aggregates.insert(1, representative_product().alias("product_id"))
    return items.groupBy("order_id").agg(*aggregates)


# The output names; an aggregate of each product column per order.
PRODUCT_MEANS = {
    "avg_name_length": "product_name_lenght",
    "avg_description_length": "product_description_lenght",
    "avg_product_volume_per_order": "product_volume",
    "avg_product_density": "product_density",
}
PRODUCT_TOTALS = {
    "total_photos": "product_photos_qty",
    "total_weight_g": "product_weight_g",
    "total_volume": "product_volume",
    "total_product_density": "product_density",
}
CATEGORY = "product_category_name"
PRODUCT_INPUTS = sorted({*PRODUCT_MEANS.values(), *PRODUCT_TOTALS.values(), CATEGORY})


def _product_aggregates() -> list[Column]:
    means = [F.avg(src).alias(name) for name, src in PRODUCT_MEANS.items()]
    totals = [F.sum(src).alias(name) for name, src in PRODUCT_TOTALS.items()]
    # size of the set, not count_distinct, which would make a second copy of every row
    categories = [
        joined_set(CATEGORY).alias("category"),
        F.size(F.collect_set(CATEGORY)).cast("long").alias("distincy_category_count"),
    ]
    return means + totals + categories


def _with_products(items: DataFrame, products: DataFrame, spread: Sequence[str]) -> DataFrame:
    return attach(items, products.select("product_id", *PRODUCT_INPUTS), "product_id", spread)


def item_product_agg(
    items: DataFrame, products: DataFrame, representative: bool = False
) -> DataFrame:
    """Per order: lengths, photos, weight, volume, density and categories of its products.

    By default all products of an order count. With ``representative`` one product stands for
    the order; its row is then already the order's row and nothing is left to group.
    """
    if not representative:
        lines = items.select("order_id", "order_item_id", "product_id")
        joined = _with_products(lines, products, ["order_id", "order_item_id"])
        return drop_nulls(joined).groupBy("order_id").agg(*_product_aggregates())
    one = items.groupBy("order_id").agg(representative_product().alias("product_id"))
    row = drop_nulls(_with_products(one, products, ["order_id"]))
    return _single_product_columns(row)


def _single_product_columns(row: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    photos = F.col("product_photos_qty").cast("long")
    means = [F.col(src).cast("double").alias(name) for name, src in PRODUCT_MEANS.items()]
    totals = [
        (photos if src == "product_photos_qty" else F.col(src)).alias(name)
        for name, src in PRODUCT_TOTALS.items()
    ]
    return row.select(
        "order_id",
        *also,
        *means,
        *totals,
        F.col(CATEGORY).alias("category"),
        F.lit(1).cast("long").alias("distincy_category_count"),
    )


def order_item_profile(
    items: DataFrame,
    products: DataFrame,
    representative: bool = False,
    money_scale: int | None = MONEY_SCALE,
) -> DataFrame:
    """``item_order_agg`` and ``item_product_agg`` together, over one shuffle by order.

    Product columns are null for an order none of whose products is known.
    """
    if not representative:
        # a line is much slimmer than the buffers it would fill, and after the join an order's lines lie
        # apart: they are brought together first, and every order is added up in one place
        joined = _with_products(items.select(*ITEM_INPUTS), products, ["order_id", "order_item_id"])
        lines = item_features(joined.drop("product_id").repartition("order_id"))
        return lines.groupBy("order_id").agg(*_item_aggregates(money_scale), *_product_aggregates())
    agg = item_order_agg(item_features(items), money_scale=money_scale)
    kept = [c for c in agg.columns if c not in ("order_id", "product_id")]
    return _single_product_columns(_with_products(agg, products, ["order_id"]), also=kept)


# -- payments ---------------------------------------------------------------------------------


def payment_features(payments: DataFrame) -> DataFrame:
    """Value of one installment; null where there are none."""
    per_installment = F.col("payment_value") / F.col("payment_installments")
    return payments.withColumn(
        "installment_value",
        F.when(F.col("payment_installments") > 0, per_installment).otherwise(F.lit(None)),
    )


def one_hot(
    df: DataFrame, column: str, values: Iterable[str] | None = None, prefix: str = "dummy_"
) -> DataFrame:
    """A 1/0 column per value; the values are found in the data when not given."""
    if values is None:
        values = learn_values(df, column)
    flags = [flag(F.col(column) == v).alias(f"{prefix}{v}") for v in values]
    return df.select("*", *flags)


def learn_values(df: DataFrame, column: str, limit: int | None = None) -> list[str]:
    """The sorted distinct values of a category column; an error above ``limit``, if given."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    rows = (values if limit is None else values.limit(limit + 1)).collect()
    if limit is not None and len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} values")
    return sorted(r[0] for r in rows)


def order_totals(payments: DataFrame, money_scale: int | None = MONEY_SCALE) -> DataFrame:
    return payments.groupBy("order_id").agg(
        money_total("payment_value", money_scale).alias("monetary_value")
    )


def with_order_total(payments: DataFrame, money_scale: int | None = MONEY_SCALE) -> DataFrame:
    """Add the order's total payment to each of its payments."""
    return attach(
        payments,
        order_totals(payments, money_scale),
        "order_id",
        spread=["payment_sequential", "payment_type", "payment_value"],
    )


def payment_order_agg(
    payments: DataFrame,
    types: Iterable[str] = PAYMENT_TYPES,
    money_scale: int | None = MONEY_SCALE,
) -> DataFrame:
    """Per order: which payment types occur, number of payments, total, installments."""
    return payments.groupBy("order_id").agg(
        *[F.max(flag(F.col("payment_type") == t)).alias(f"dummy_{t}") for t in types],
        F.max("payment_sequential").alias("total_payment_sequential"),
        money_total("payment_value", money_scale).alias("total_payment_value"),
        F.avg("payment_installments").alias("avg_payment_installments"),
        F.max("payment_installments").alias("max_payment_installments"),
    )


# -- reviews ----------------------------------------------------------------------------------


def binary_label(
    df: DataFrame, score: str = "review_score", threshold: int = 4, name: str = "review"
) -> DataFrame:
    """1 for a score at or above the threshold, 0 below, null for no score; drops the score."""
    return df.withColumn(name, at_least(score, threshold)).drop(score)


def review_features(reviews: DataFrame) -> DataFrame:
    """The label, and the days between the review's creation and its answer."""
    return binary_label(reviews).withColumn(
        "review_responsiveness", elapsed_days("review_answer_timestamp", "review_creation_date")
    )


def with_latest_timestamp(reviews: DataFrame) -> DataFrame:
    """Add the time of the order's last review to every review of the order."""
    latest = reviews.groupBy("order_id").agg(
        F.max("review_answer_timestamp").alias("latest_timestamp")
    )
    return attach(reviews, latest, "order_id", spread=["review_id"])


def latest_review(reviews: DataFrame) -> DataFrame:
    """The last answered review of every order, with its features."""
    last = latest_per_key(reviews, "order_id", "review_answer_timestamp", "review_id")
    return review_features(last).withColumn("latest_timestamp", F.col("review_answer_timestamp"))
