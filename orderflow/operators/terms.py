"""Columns derived from an order or a line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions.dates import midnight_after
from orderflow.functions.numbers import (
    account_number,
    price_from_cents,
    purchase_order_number,
    tax_on,
)

# Fixed values of every order.
DUE_DAYS, SHIP_DAYS = 15, 7
STATUS, ONLINE_ORDER_FLAG, SHIP_METHOD_ID, REVISION_NUMBER = 5, 0, 1, 8


def order_terms(orders: DataFrame) -> DataFrame:
    """Adds dates, tax and the constant terms to (orderdate, subtotal)."""
    return orders.withColumns(
        {
            "orderdate": midnight_after(F.col("orderdate"), 0),
            "duedate": midnight_after(F.col("orderdate"), DUE_DAYS),
            "shipdate": midnight_after(F.col("orderdate"), SHIP_DAYS),
            "taxamt": tax_on(F.col("subtotal")),
            "status": F.lit(STATUS),
            "onlineorderflag": F.lit(ONLINE_ORDER_FLAG),
            "shipmethodid": F.lit(SHIP_METHOD_ID),
            "revisionnumber": F.lit(REVISION_NUMBER),
        }
    )


def document_numbers(orders: DataFrame) -> DataFrame:
    """Adds the order's two numbers to (ponumber, branch, serial)."""
    return orders.withColumns(
        {
            "purchaseordernumber": purchase_order_number(F.col("ponumber")),
            "accountnumber": account_number(F.col("branch"), F.col("serial")),
        }
    )


def unit_prices(lines: DataFrame) -> DataFrame:
    """Adds price and discount, both to the cent, to (pricecents, discount)."""
    return lines.withColumns(
        {
            "unitprice": price_from_cents(F.col("pricecents")),
            "unitpricediscount": F.round("discount", 2),
        }
    )
