"""Net changes joined to order header, lines, product and address."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.operators.joins import childless, children_of, fan_out, look_up
from orderflow.session import Settle, unsettled

OPERATIONS = ("I", "U", "D")


def join_changes_header(net: DataFrame, header: DataFrame) -> DataFrame:
    """Every change with its header; a deleted order has none and keeps NULLs."""
    columns = header.select(
        "salesorderid",
        "shiptoaddressid",
        F.col("orderdate").alias("OrderDate"),
        F.col("modifieddate").alias("orderupdatedtm"),
    )
    return net.join(columns, "salesorderid", "left")


def join_changes_detail(changes: DataFrame, detail: DataFrame) -> DataFrame:
    """Fan out to one row per line; an order without lines keeps one row."""
    return fan_out(changes, wire_lines(detail), "salesorderid")


def wire_lines(detail: DataFrame) -> DataFrame:
    return detail.select(
        "salesorderid",
        F.col("productid").alias("ProductID"),
        F.col("orderqty").alias("productorderqty"),
        F.col("linetotal").alias("productsales"),
    )


def capture_orders(
    net: DataFrame,
    header: DataFrame,
    detail: DataFrame,
    product: DataFrame,
    address: DataFrame,
    batch_id: int,
    settle: Settle = unsettled,
) -> DataFrame:
    """One row per line of each changed order, under the wire's names.

    The address is looked up per changed order, before the fan-out: fewer rows,
    and orders without a header never meet in one partition of NULL keys. Product
    is looked up on lines that exist, for the same reason.
    """
    postal = address.select(
        F.col("addressid").alias("shiptoaddressid"), F.col("postalcode").alias("PostalCode")
    )
    headers = settle(join_changes_header(net, header), "changed_headers")
    changes = settle(look_up(headers, postal, "shiptoaddressid"), "changed_orders")
    changes = changes.drop("shiptoaddressid")
    names = product.select(
        F.col("productid").alias("ProductID"), F.col("name").alias("productname")
    )
    lines = children_of(changes, wire_lines(detail), "salesorderid")
    lines = settle(lines, "changed_lines")  # the only scan of the detail table
    lineless = childless(changes, lines, "salesorderid")
    matched = look_up(lines, names, "ProductID")
    return matched.unionByName(lineless, allowMissingColumns=True).select(
        "salesorderid",
        "sys_change_op",
        "OrderDate",
        "orderupdatedtm",
        "ProductID",
        "productname",
        "PostalCode",
        "productorderqty",
        "productsales",
        F.lit(batch_id).cast("bigint").alias("job_exec_id"),
    )


def count_by_op(captured: DataFrame) -> DataFrame:
    return captured.groupBy("sys_change_op").agg(F.count(F.lit(1)).alias("row_count"))


def count_by_op_total(captured: DataFrame) -> DataFrame:
    """Rows per operation and, with a NULL operation, in total: one pass."""
    return captured.rollup("sys_change_op").agg(F.count(F.lit(1)).alias("row_count"))
