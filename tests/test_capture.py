from __future__ import annotations

from orderflow.operators.capture import capture_orders, count_by_op_total
from tests.rows import dicts


def tables(spark):
    net = spark.createDataFrame(
        [(1, "I"), (2, "D"), (3, "U"), (4, "D")], "salesorderid long, sys_change_op string"
    )
    header = spark.sql(
        """select * from values
        (1L, 10L, timestamp_ntz'2020-01-01 00:00:00', timestamp_ntz'2020-01-02 03:00:00'),
        (3L, 99L, timestamp_ntz'2020-01-01 00:00:00', timestamp_ntz'2020-01-02 04:00:00'),
        (7L, 10L, timestamp_ntz'2020-01-01 00:00:00', timestamp_ntz'2020-01-02 05:00:00')
        as t(salesorderid, shiptoaddressid, orderdate, modifieddate)"""
    )
    detail = spark.createDataFrame(
        [(1, 5, 2), (1, 6, 3), (4, 5, 1), (7, 5, 9)],
        "salesorderid long, productid long, orderqty int",
    ).selectExpr("*", "cast(orderqty as decimal(18,4)) as linetotal")
    product = spark.createDataFrame([(5, "five")], "productid long, name string")
    address = spark.createDataFrame([(10, "00010")], "addressid long, postalcode string")
    return net, header, detail, product, address


def test_outer_joins_keep_every_change(spark):
    rows = dicts(capture_orders(*tables(spark), batch_id=8))
    found = {
        (r["salesorderid"], r["ProductID"]): (
            r["sys_change_op"], r["productname"], r["PostalCode"], r["productorderqty"],
        )
        for r in rows
    }
    assert found == {
        (1, 5): ("I", "five", "00010", 2),
        (1, 6): ("I", None, "00010", 3),  # product unknown
        (2, None): ("D", None, None, None),  # deleted: no header, no lines
        (3, None): ("U", None, None, None),  # no lines, address unknown
        (4, 5): ("D", "five", None, 1),  # deleted, but its lines still stand
    }
    assert len(rows) == 5 and {r["job_exec_id"] for r in rows} == {8}


def test_counts_per_operation_and_in_total(spark):
    counts = dicts(count_by_op_total(capture_orders(*tables(spark), batch_id=8)))
    assert {r["sys_change_op"]: r["row_count"] for r in counts} == {"I": 2, "D": 2, "U": 1, None: 5}
