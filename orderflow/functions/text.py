"""Between typed columns and the all-text wire."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_text(name: str) -> Column:
    """NULL stays NULL; times take the form with a space, not the ISO ``T``."""
    return F.col(name).cast("string").alias(name)


def without_null_text(value: Column, null_text: str | None) -> Column:
    """Old wire files hold NULL as a word. Empty text stays empty text."""
    return value if null_text is None else F.nullif(value, F.lit(null_text))


def unreadable(value: Column, kind: T.DataType) -> Column:
    return value.isNotNull() & value.try_cast(kind).isNull()
