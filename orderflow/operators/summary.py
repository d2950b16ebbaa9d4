"""The view over live rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions.numbers import money_sum


def live_orders(orders: DataFrame) -> DataFrame:
    """A NULL flag is not live."""
    return orders.where(F.col("deleted_flg") == 0)


def order_summary(orders: DataFrame) -> DataFrame:
    hour = F.hour("orderupdatedtm").alias("orderhour")
    return (
        live_orders(orders)
        .groupBy("orderdate", hour, "productid", "productname", "postalcode")
        .agg(
            F.sum("productorderqty").alias("productsalesvolume"),
            money_sum(F.col("productsales")).alias("productsales"),
        )
    )
