from __future__ import annotations

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from test_features import ITEMS, PAYMENTS, PRODUCTS, REVIEWS

from reviewlab.operators.profiling import assert_unique_key
from reviewlab.plans.base_table import HELPER_COLUMNS, build_base_table
from reviewlab.sources import adapters as A
from reviewlab.sources.schemas import SCHEMAS
from reviewlab.sources.tables import Tables, export_predictions, read_table, read_tables, write_table

T = "2024-01-0"


def tables(spark):
    text = "order_id string, customer_id string, order_status string, " + ", ".join(
        f"{c} string" for c in (
            "order_purchase_timestamp order_approved_at order_delivered_carrier_date "
            "order_delivered_customer_date order_estimated_delivery_date"
        ).split()
    )
    stamps = [f"{T}{d} 10:00:00" for d in (1, 2, 3, 4, 9)]
    orders = [
        ("o1", "c1", "delivered", *stamps),
        ("o1", "c1", "delivered", *stamps),
        ("o2", "c1", "delivered", "bad", *stamps[1:]),
        ("o3", "c2", "delivered", *stamps),
        ("o4", "c2", "delivered", *stamps),
    ]
    at = datetime(2024, 1, 6)
    return Tables(
        products=spark.createDataFrame(
            [("p1", "toys", 1, 2, 3, 4.0, 1.0, 2.0, 3.0), ("p2", "art", 1, 2, 3, None, 1.0, 2.0, 3.0)],
            PRODUCTS,
        ),
        orders=spark.createDataFrame(orders, text),
        items=spark.createDataFrame(
            [("o1", 1, "p1", 5.0, 1.0), ("o1", 2, "p2", 5.0, 1.0), ("o3", 1, "p2", 5.0, 1.0),
             ("o4", 1, "p1", 5.0, 1.0)],
            ITEMS,
        ),
        payments=spark.createDataFrame(
            [("o1", 1, "voucher", 1, 6.0), ("o1", 2, "mobile", 2, 6.0), ("o3", 1, "mobile", 1, 6.0),
             ("o4", 1, "mobile", 0, 6.0)],
            PAYMENTS,
        ),
        reviews=spark.createDataFrame(
            [("r1", "o1", 2, at, at), ("r2", "o1", 5, at, datetime(2024, 1, 7)),
             ("r4", "o4", 5, at, at)],
            REVIEWS,
        ),
    )


def test_one_row_per_order(spark):
    base = build_base_table(tables(spark))
    got = {r["order_id"]: r for r in assert_unique_key(base, "order_id").collect()}
    # o2 has a bad date, o3 only a product that was cleaned away
    assert sorted(got) == ["o1", "o4"]
    row = got["o1"]
    assert (row.order_count, row.review, row.nbr_items) == (1, 1, 2)
    assert (row.category, row.monetary_value, row.dummy_mobile, row.dummy_voucher) == ("toys", 12.0, 1, 1)
    assert not set(HELPER_COLUMNS) & set(base.columns)


def test_row_grain(spark):
    base = build_base_table(tables(spark), payment_grain="row").collect()
    # the payment of o4 has no installments
    assert sorted((r.order_id, r.payment_sequential) for r in base) == [("o1", 1), ("o1", 2)]
    assert {r.review for r in base} == {1} and {r.monetary_value for r in base} == {12.0}
    with pytest.raises(ValueError):
        build_base_table(tables(spark), payment_grain="item")


def test_training_and_scoring_features_agree(spark):
    full = tables(spark)
    train = build_base_table(full)
    blind = Tables(full.products, full.orders, full.items, full.payments)
    scoring = build_base_table(blind)
    assert set(train.columns) - set(scoring.columns) == {"review", "latest_timestamp"}
    same = train.select(scoring.columns)
    assert scoring.exceptAll(same).count() == 0


def test_helpers_are_kept_on_request(spark):
    kept = build_base_table(tables(spark), keep_helpers=True).columns
    assert "delivery_delay" in kept and "review_responsiveness" in kept


def test_tables_from_csv(spark, tmp_path):
    source = A.tables(spark, "/root/testdata/sf0.001")
    paths = {}
    for role, schema in SCHEMAS.items():
        paths[role] = str(tmp_path / role)
        df = getattr(source, role)
        write_table(df.select([F.col(f.name) for f in schema.fields]), paths[role], fmt="csv")
    read = read_tables(spark, paths)
    want = build_base_table(source, payment_types=A.PAYMENT_TYPES)
    got = build_base_table(read, payment_types=A.PAYMENT_TYPES)
    assert got.count() == want.count() > 0
    ours = got.withColumn("order_id", F.col("order_id").cast("long")).select(want.columns)
    columns = [c for c in want.columns if "ratio" not in c and "density" not in c]
    assert ours.select(columns).exceptAll(want.select(columns)).count() == 0


def test_csv_header_must_match(spark, tmp_path):
    write_table(spark.range(3).toDF("x"), str(tmp_path / "t"), fmt="csv")
    with pytest.raises(Exception):
        read_table(spark, str(tmp_path / "t"), SCHEMAS["items"]).collect()
    with pytest.raises(ValueError):
        read_table(spark, str(tmp_path / "t"))


def test_export(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("b", 0.0)], "order_id string, prediction double")
    export_predictions(df, str(tmp_path / "out"))
    back = read_table(spark, str(tmp_path / "out"), df.schema)
    assert sorted(map(tuple, back.collect())) == [("a", 1.0), ("b", 0.0)]


def test_repeated_keys_give_one_row_per_order(spark):
    """A second version of an order, or of a product, multiplies neither rows nor money."""
    tables = A.tables(spark, "/root/testdata/sf0.001")
    plain = build_base_table(tables, payment_types=A.PAYMENT_TYPES)
    again = tables.orders.withColumn("order_status", F.lit(""))
    twice = replace(tables, orders=tables.orders.unionByName(again))
    base = build_base_table(twice, payment_types=A.PAYMENT_TYPES)
    total = F.sum("total_price").cast("decimal(20,4)")
    assert base.count() == base.select("order_id").distinct().count() == plain.count()
    assert base.agg(total).first() == plain.agg(total).first()
