"""The feature state: equal features for equal orders, unknown customers, saving."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from reviewlab.plans import scoring as sc
from reviewlab.plans import state as st

START = datetime(2020, 1, 1, 12)
SCHEMA = "order_id long, customer_id long, order_purchase_timestamp timestamp_ntz"


def orders(spark, *rows):
    return spark.createDataFrame([(i, c, START + timedelta(days=d)) for i, c, d in rows], SCHEMA)


def by_customer(history):
    return {r.customer_id: (r.order_count, r.recency) for r in history.collect()}


def test_same_orders_same_history(spark, tmp_path):
    seen = orders(spark, (1, 1, 0), (2, 1, 5), (3, 2, 9), (4, 3, 10))
    st.learn(seen).save(str(tmp_path))
    state = st.load(spark, str(tmp_path))
    assert state.as_of == START + timedelta(days=10)
    whole = {1: (2, 5), 2: (1, 1), 3: (1, 0)}
    assert by_customer(state.history_of(seen)) == whole
    assert by_customer(state.history_of(seen.filter("order_id = 1"))) == whole


def test_new_orders_and_customers_count(spark):
    state = st.learn(orders(spark, (1, 1, 0), (2, 1, 5), (3, 2, 10)))
    new = orders(spark, (9, 1, 12), (10, 7, 3), (11, 7, 4), (12, 8, 11), (2, 1, 5))
    assert by_customer(state.history_of(new)) == {1: (3, -2), 2: (1, 0), 7: (2, 6), 8: (1, -1)}


def test_empty_state(spark):
    state = st.learn(spark.createDataFrame([], SCHEMA))
    assert state.as_of is None
    got = state.history_of(orders(spark, (1, 1, 0))).collect()
    assert [(r.order_count, r.recency) for r in got] == [(1, None)]


def test_scoring_asks_for_the_state():
    with pytest.raises(ValueError):
        sc.scoring_table(None, None)


def test_clashing_columns(spark):
    seen = orders(spark, (1, 1, 0)).withColumn("order_count", F.lit(99)).withColumn("day", F.lit(1))
    assert by_customer(st.learn(seen).history_of(seen)) == {1: (1, 0)}
