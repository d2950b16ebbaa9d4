"""Dates of the order terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def midnight_after(moment: Column, days: int) -> Column:
    return F.date_add(F.to_date(moment), days).cast("timestamp_ntz")
