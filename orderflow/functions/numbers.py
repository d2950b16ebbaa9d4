"""Money and document numbers."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the order terms.
TAX_RATE = Decimal("0.07898")
MONEY = "decimal(18,4)"
# Sums of sales: six decimals hold every line total, and adding decimals gives
# the same sum for any number of partitions.
EXACT = "decimal(28,6)"


def money_sum(amount: Column) -> Column:
    return F.sum(amount.cast(EXACT)).cast("double")


def tax_on(subtotal: Column) -> Column:
    return (subtotal.cast(MONEY) * F.lit(TAX_RATE)).cast(MONEY)


def price_from_cents(cents: Column) -> Column:
    return F.round(cents.cast("decimal(18,0)") / F.lit(Decimal(100)), 2).cast("decimal(18,2)")


def zero_padded(number: Column, width: int) -> Column:
    """At least ``width`` digits; longer numbers stay whole (lpad would cut)."""
    digits = number.cast("string")
    return F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))


def purchase_order_number(number: Column) -> Column:
    return F.concat(F.lit("PO"), zero_padded(number, 8))


def account_number(branch: Column, serial: Column) -> Column:
    return F.concat(F.lit("10-"), zero_padded(branch, 4), F.lit("-"), zero_padded(serial, 6))
