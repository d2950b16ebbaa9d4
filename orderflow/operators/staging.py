"""From staged rows to the source of a merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions.numbers import money_sum
from orderflow.schemas import STAGING

LINES = "line_count"
GROUP_KEYS = (
    "salesorderid",
    "orderdate",
    "postalcode",
    "productid",
    "productname",
    "orderupdatedtm",
    "src_cdt_batch_id",
    "sys_change_op",
)


def _folded(staged: DataFrame) -> DataFrame:
    quantity = F.col("productorderqty")
    return staged.groupBy(*GROUP_KEYS).agg(
        F.try_sum(quantity).alias("productorderqty"),
        money_sum(F.col("productsales")).alias("productsales"),
        F.count(quantity).alias("quantities"),
        F.count(F.lit(1)).alias(LINES),
    )


def _overflows() -> Column:
    return F.col("productorderqty").isNull() & (F.col("quantities") > 0)


def stage_preagg(staged: DataFrame, with_lines: bool = False) -> DataFrame:
    """Fold repeated (order, product) lines; NULL keys group together. Partial
    sums are taken before the shuffle. A quantity beyond 64 bits is an error that
    names its line. ``with_lines`` adds how many lines each row was made of."""
    error = F.concat(
        F.lit("quantity of a line overflows: "), F.to_json(F.struct("salesorderid", "productid"))
    )
    quantity = F.when(_overflows(), F.raise_error(error).cast("bigint")).otherwise(
        F.col("productorderqty")
    )
    folded = _folded(staged).withColumn("productorderqty", quantity)
    return folded.select(*STAGING.names, *([LINES] if with_lines else []))


def quantity_overflows(staged: DataFrame) -> DataFrame:
    """The lines whose quantities cannot be summed, and how many there are."""
    return _folded(staged).where(_overflows()).select("salesorderid", "productid", LINES)


def latest_batch_per_order(staged: DataFrame) -> DataFrame:
    """Rows of each order's highest batch. A batch holds all lines of a changed
    order, so older batches of that order are out of date as a whole.

    An aggregate and a join rather than a window: a window would gather all
    lines of an order in one task."""
    latest = staged.groupBy(F.col("salesorderid").alias("latest_order")).agg(
        F.max("src_cdt_batch_id").alias("latest_batch")
    )
    same = F.col("salesorderid").eqNullSafe(F.col("latest_order")) & F.col(
        "src_cdt_batch_id"
    ).eqNullSafe(F.col("latest_batch"))
    return staged.join(latest, same).drop("latest_order", "latest_batch")


def merge_conflicts(source: DataFrame, per_batch: bool = False) -> DataFrame:
    """Keys with more than one source row, or with more than one in a batch.
    NULL products are one product here."""
    keys = ["salesorderid", "productid", *(["src_cdt_batch_id"] if per_batch else [])]
    return (
        source.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where(F.col("row_count") > 1)
    )
