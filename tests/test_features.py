from __future__ import annotations

from datetime import datetime

import pytest

from reviewlab.functions.expressions import money_mean, money_total
from reviewlab.operators import features as ft

ITEMS = "order_id string, order_item_id int, product_id string, price double, shipping_cost double"
PAYMENTS = (
    "order_id string, payment_sequential int, payment_type string, "
    "payment_installments int, payment_value double"
)
ORDERS = (
    "order_id string, customer_id string, order_purchase_timestamp timestamp_ntz, "
    "order_approved_at timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
    "order_estimated_delivery_date timestamp_ntz"
)
PRODUCTS = (
    "product_id string, product_category_name string, product_name_lenght int, "
    "product_description_lenght int, product_photos_qty int, product_weight_g double, "
    "product_length_cm double, product_height_cm double, product_width_cm double"
)
REVIEWS = (
    "review_id string, order_id string, review_score int, "
    "review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz"
)


def rows(df, key="order_id"):
    return {r[key]: r for r in df.collect()}


def test_product_divisors_of_zero_give_null(spark):
    data = [
        ("p1", "toys", 1, 2, 3, 2.0, 1.0, 2.0, 3.0),
        ("p2", "toys", 1, 2, 3, 0.0, 1.0, 2.0, 3.0),
        ("p3", "toys", 1, 2, 3, 5.0, 0.0, 2.0, 3.0),
        ("p4", "toys", 1, 2, 3, None, 1.0, 2.0, 3.0),
    ]
    got = rows(ft.product_features(spark.createDataFrame(data, PRODUCTS)), "product_id")
    assert (got["p1"].product_volume, got["p1"].size_to_weight_ratio) == (6.0, 3.0)
    assert got["p1"].product_density == pytest.approx(1 / 3)
    assert got["p2"].size_to_weight_ratio is None and got["p2"].product_density == 0.0
    assert got["p3"].product_density is None and got["p3"].size_to_weight_ratio == 0.0
    assert got["p4"].size_to_weight_ratio is None and got["p4"].product_density is None


def test_delivery_days_are_calendar_days(spark):
    at = datetime
    data = [
        ("o1", "c1", at(2024, 1, 1, 23, 59), at(2024, 1, 2, 0, 0), at(2024, 1, 2, 0, 1), at(2024, 1, 1)),
        ("o2", "c1", at(2024, 1, 1), at(2024, 1, 1, 5), None, at(2024, 1, 9)),
    ]
    got = rows(ft.delivery_features(spark.createDataFrame(data, ORDERS)))
    assert (got["o1"].delivery_duration, got["o1"].approval_duration) == (1, 1)
    assert got["o1"].delivery_delay == -1
    assert got["o2"].delivery_duration is None and got["o2"].approval_duration == 0


def test_customer_history(spark):
    day = lambda d: datetime(2024, 1, d, 12)
    data = [(f"o{i}", c, day(d), day(d), day(d), day(d)) for i, (c, d) in enumerate(
        [("one", 10), ("three", 1), ("three", 5), ("three", 3)]
    )]
    orders = spark.createDataFrame(data, ORDERS)
    got = rows(ft.customer_history(orders), "customer_id")
    assert (got["three"].order_count, got["three"].recency) == (3, 5)
    assert got["three"].first_order_date == day(1) and got["three"].last_order_date == day(5)
    fixed = rows(ft.customer_history(orders, "2024-02-01"), "customer_id")
    assert fixed["one"].recency == 22
    joined = rows(ft.with_customer_history(orders))
    assert [joined[f"o{i}"].is_repeated_customer for i in range(4)] == [0, 1, 1, 1]


def test_item_aggregates(spark):
    data = [
        ("o1", 3, "pA", 10.10, 1.0),
        ("o1", 1, "pZ", 20.20, 2.0),
        ("o1", 1, "pB", 0.0, 3.0),
        ("o2", 2, "pC", None, 1.0),
    ]
    items = ft.item_features(spark.createDataFrame(data, ITEMS))
    got = rows(ft.item_order_agg(items))
    assert (got["o1"].nbr_items, got["o1"].product_id) == (3, "pB")
    assert (got["o1"].total_price, got["o1"].min_price, got["o1"].max_price) == (30.3, 0.0, 20.2)
    assert got["o1"].avg_price == pytest.approx(10.1)
    assert got["o1"].avg_shipping_to_price_ratio == pytest.approx((1 / 10.1 + 2 / 20.2) / 2)
    assert got["o2"].total_price is None and got["o2"].nbr_items == 1
    plain = rows(ft.item_order_agg(items, money_scale=None))
    assert plain["o1"].total_price == pytest.approx(30.3)


def products(spark):
    data = [
        ("pA", "toys", 10, 100, 1, 2.0, 1.0, 1.0, 4.0),
        ("pB", "art", 20, 200, 2, 4.0, 2.0, 2.0, 2.0),
    ]
    return ft.product_features(spark.createDataFrame(data, PRODUCTS))


def test_item_products(spark):
    data = [
        ("o1", 1, "pA", 1.0, 1.0),
        ("o1", 2, "pB", 1.0, 1.0),
        ("o1", 3, "pB", 1.0, 1.0),
        ("o2", 1, "none", 1.0, 1.0),
        ("o3", 1, "none", 1.0, 1.0),
        ("o3", 2, "pA", 1.0, 1.0),
    ]
    items = spark.createDataFrame(data, ITEMS)
    got = rows(ft.item_product_agg(items, products(spark)))
    assert sorted(got) == ["o1", "o3"]
    assert (got["o1"].category, got["o1"].distincy_category_count) == ("art, toys", 2)
    assert (got["o1"].total_photos, got["o1"].total_volume) == (5, 20.0)
    assert got["o1"].avg_name_length == pytest.approx(50 / 3)
    single = rows(ft.item_product_agg(items, products(spark), representative=True))
    assert sorted(single) == ["o1"]
    assert (single["o1"].category, single["o1"].distincy_category_count) == ("toys", 1)
    whole = rows(ft.order_item_profile(items, products(spark)))
    assert sorted(whole) == ["o1", "o2", "o3"]
    assert whole["o1"].total_volume == 20.0 and whole["o1"].nbr_items == 3
    assert whole["o2"].total_volume is None and whole["o2"].nbr_items == 1


def test_lines_and_not_buffers_are_moved_to_their_order(spark):
    items = spark.createDataFrame([("o1", 1, "pA", 1.0, 1.0)], ITEMS)
    profile = ft.order_item_profile(items, products(spark))
    plan = profile._jdf.queryExecution().executedPlan().toString()
    # read from the top: both halves of the sums come before the shuffle by order
    assert "partial_min" in plan.partition("Exchange hashpartitioning(order_id")[0]


def test_payments(spark):
    data = [
        ("o1", 1, "voucher", 2, 10.0),
        ("o1", 2, "credit_card", 0, 5.5),
        ("o2", 1, None, None, 7.0),
        ("o3", 1, "barter", 1, 1.0),
    ]
    payments = spark.createDataFrame(data, PAYMENTS)
    value = {(r.order_id, r.payment_sequential): r.installment_value
             for r in ft.payment_features(payments).collect()}
    assert value == {("o1", 1): 5.0, ("o1", 2): None, ("o2", 1): None, ("o3", 1): 1.0}
    got = rows(ft.payment_order_agg(payments))
    assert len(got) == 3
    assert (got["o1"].dummy_voucher, got["o1"].dummy_credit_card, got["o1"].dummy_mobile) == (1, 1, 0)
    assert (got["o1"].total_payment_value, got["o1"].total_payment_sequential) == (15.5, 2)
    assert (got["o1"].avg_payment_installments, got["o1"].max_payment_installments) == (1.0, 2)
    flags = [got[o][f"dummy_{t}"] for o in ("o2", "o3") for t in ft.PAYMENT_TYPES]
    assert flags == [0] * 8
    total = [r.monetary_value for r in ft.with_order_total(payments).collect() if r.order_id == "o1"]
    assert total == [15.5, 15.5]


def test_one_hot_learns_values(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "t string")
    hot = ft.one_hot(df, "t")
    assert hot.columns == ["t", "dummy_a", "dummy_b"]
    assert sorted(map(tuple, hot.select("dummy_a", "dummy_b").collect())) == [(0, 0), (0, 1), (1, 0)]
    with pytest.raises(ValueError):
        ft.learn_values(spark.range(10), "id", limit=5)


def test_reviews(spark):
    at = datetime
    data = [
        ("r1", "o1", 3, at(2024, 1, 1), at(2024, 1, 2)),
        ("r2", "o1", 5, at(2024, 1, 1), at(2024, 1, 3, 12)),
        ("r3", "o2", 4, at(2024, 1, 1), at(2024, 1, 2)),
        ("r4", "o2", 2, at(2024, 1, 1), at(2024, 1, 2)),
        ("r5", "o3", None, at(2024, 1, 1), at(2024, 1, 2)),
    ]
    reviews = spark.createDataFrame(data, REVIEWS)
    got = rows(ft.latest_review(reviews))
    assert {k: (r.review_id, r.review) for k, r in got.items()} == {
        "o1": ("r2", 1), "o2": ("r4", 0), "o3": ("r5", None)
    }
    assert got["o1"].review_responsiveness == 2.5
    labels = {r.review_id: r.review for r in ft.binary_label(reviews).collect()}
    assert labels == {"r1": 0, "r2": 1, "r3": 1, "r4": 0, "r5": None}
    latest = {r.review_id: r.latest_timestamp for r in ft.with_latest_timestamp(reviews).collect()}
    assert latest["r1"] == at(2024, 1, 3, 12) and len(latest) == 5


def test_money_keeps_small_amounts_and_leaves_out_nan(spark):
    rows_ = [("o", 1, "p", 10.00004, 0.0), ("o", 2, "p", 10.00004, 0.0), ("n", 1, "p", float("nan"), 1.0)]
    items = spark.createDataFrame(
        rows_, "order_id string, order_item_id int, product_id string, price double, shipping_cost double"
    )
    got = {r.order_id: r for r in ft.item_order_agg(ft.item_features(items)).collect()}
    assert got["o"].total_price == 20.00008
    assert got["o"].avg_price >= got["o"].min_price
    assert got["n"].total_price is None


@pytest.mark.parametrize(
    "amounts, total",
    [
        ([1e18, 5.0], 1e18 + 5.0),
        ([1e18, 300.0, 200.0], 1e18 + 500.0),
        ([1e18, 1e18, -2e18, 7.25], 7.25),
        ([1e-12, 2e-12], 3e-12),
        ([0.1] * 10, 1.0),
        ([1e30, 5.0, -1e30], 5.0),
        ([float("nan"), 2.0, float("inf"), None], 2.0),
        ([float("nan"), None], None),
    ],
)
def test_no_amount_is_lost(spark, amounts, total):
    for order in (amounts, amounts[::-1]):
        df = spark.createDataFrame([(a,) for a in order], "a double").coalesce(1)
        got = df.agg(money_total("a").alias("t"), money_mean("a").alias("m")).first()
        n = sum(a is not None and abs(a) < float("inf") for a in amounts)
        assert got.t == (None if total is None else pytest.approx(total, rel=1e-15))
        assert got.m == (None if total is None else pytest.approx(total / n, rel=1e-15))


def test_large_amounts_in_order_features(spark):
    rows = [(1, 1, 9, 1e18, 5.0), (1, 2, 9, 5.0, 1e-12)]
    items = spark.createDataFrame(
        rows, "order_id int, order_item_id int, product_id int, price double, shipping_cost double"
    )
    got = ft.item_order_agg(ft.item_features(items)).first()
    assert (got.total_price, got.max_price, got.avg_price) == (1e18, 1e18, 5e17)
    assert got.total_shipping_cost == 5.000000000001
