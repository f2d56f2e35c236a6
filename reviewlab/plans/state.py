"""What scoring needs from training beside the model: the customers' history and its last day.

Recency, order counts and the repeat-customer flag depend on the orders at hand. A model trained on
all orders and applied to a week's would see other values for the same customer; so the history and
the day it was counted to are learnt once, saved with the model and used for scoring.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.operators import features as ft

BOUGHT = "order_purchase_timestamp"
HISTORY = "customer_id", "order_count", "first_order_date", "last_order_date"


@dataclass
class FeatureState:
    """The history of all customers up to ``as_of``, the last purchase it holds."""

    as_of: datetime | None
    history: DataFrame

    def save(self, path: str) -> None:
        spark = self.history.sparkSession
        self.history.write.mode("overwrite").parquet(f"{path}/history")
        day = spark.createDataFrame([(self.as_of,)], "as_of timestamp_ntz")
        day.coalesce(1).write.mode("overwrite").parquet(f"{path}/as_of")

    def history_of(self, orders: DataFrame) -> DataFrame:
        """The history of the customers, with orders that the state does not hold yet.

        Orders bought after ``as_of`` are new. Earlier ones count if the state doesn't know their
        customer at all, else they are in it. Recency is counted to ``as_of`` for all, so it is
        below zero after a later purchase.
        """
        known = self.history.select("customer_id")
        earlier = orders.join(known, "customer_id", "left_anti")
        new = earlier
        if self.as_of is not None:
            day = F.lit(self.as_of)
            new = earlier.filter(F.col(BOUGHT) <= day).unionByName(orders.filter(F.col(BOUGHT) > day))
        added = summary(new)
        whole = self.history.select(*HISTORY).unionByName(added).groupBy("customer_id")
        whole = whole.agg(
            F.sum("order_count").alias("order_count"),
            F.min("first_order_date").alias("first_order_date"),
            F.max("last_order_date").alias("last_order_date"),
        )
        return ft.recency(whole, "last_order_date", F.lit(self.as_of).cast("date"))


def summary(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("order_count"),
        F.min(BOUGHT).alias("first_order_date"),
        F.max(BOUGHT).alias("last_order_date"),
    )


def learn(orders: DataFrame) -> FeatureState:
    """The state after cleaned orders (``base_table.clean_orders``)."""
    return FeatureState(orders.agg(F.max(BOUGHT).alias("day")).first().day, summary(orders))


def load(spark: SparkSession, path: str) -> FeatureState:
    day = spark.read.parquet(f"{path}/as_of").first().as_of
    return FeatureState(day, spark.read.parquet(f"{path}/history"))
