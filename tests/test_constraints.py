from __future__ import annotations

import pytest

from orderflow.operators.constraints import (
    OF_LEDGER,
    OF_ORDERS,
    OF_STAGING,
    OF_SUMMARY,
    enforced,
    violations,
)
from orderflow.plans.runs import write_summary
from orderflow.schemas import ORDER_SUMMARY
from orderflow.sources.ledger_log import _append
from tests.rows import DAY, TIME, ledger, order_row, orders, source, source_row


def test_violations_name_the_row_and_the_rule(spark):
    rows = source(
        spark, source_row(1, 5), source_row(None, 5), source_row(2, 6, op="X"), source_row(3, None, None, "Y")
    )
    found = {(r.salesorderid, r.productid): r.broken for r in violations(rows, OF_STAGING).collect()}
    assert found == {
        (None, 5): "salesorderid is null",
        (2, 6): "unknown operation",
        (3, None): "src_cdt_batch_id is null; unknown operation",
    }


def test_a_null_breaks_no_rule_but_a_required_one(spark):
    assert violations(source(spark, source_row(1, 5, op=None)), OF_STAGING).count() == 0
    assert violations(orders(spark, order_row(1, None, flag=None)), OF_ORDERS).count() == 0


@pytest.mark.parametrize("write", ["staging", "orders", "ledger"])
def test_a_row_that_breaks_a_rule_stops_the_write(spark, tmp_path, write):
    path = str(tmp_path / "out")
    rows, rules = {
        "staging": (source(spark, source_row(1, 5), source_row(7, 6, op="X")), OF_STAGING),
        "orders": (orders(spark, order_row(1, 5), order_row(7, 5, flag=3)), OF_ORDERS),
        "ledger": (ledger(spark, (1, 0, 5, TIME, None), (7, 0, -5, TIME, None)), OF_LEDGER),
    }[write]
    with pytest.raises(Exception, match=r'may not be written.*:7'):
        enforced(rows, rules).write.parquet(path)
    assert enforced(rows.limit(1), rules).collect() == rows.limit(1).collect()


def test_the_ledger_checks_what_is_appended(spark, tmp_path):
    with pytest.raises(Exception, match="job_exec_id is null"):
        _append(ledger(spark, (None, 0, 1, TIME, TIME)), str(tmp_path / "ledger"))


def test_the_summary_is_written_to_its_schema(spark, tmp_path):
    path = str(tmp_path / "summary")
    write_summary(orders(spark, order_row(1, 5), order_row(2, 5), order_row(3, 5, flag=1)), path)
    row = spark.read.schema(ORDER_SUMMARY).parquet(path).first()
    assert (row.orderdate, row.orderhour, row.productsalesvolume) == (DAY, 5, 2)
    wrong = spark.createDataFrame([(DAY, 24, 5, "p", "0", 1, 1.0)], ORDER_SUMMARY)
    assert [r.broken for r in violations(wrong, OF_SUMMARY).collect()] == ["no hour of the day"]


def test_the_check_stays_in_the_plan_of_a_write(spark, tmp_path):
    rows = orders(spark, order_row(1, 5))
    text = enforced(rows, OF_ORDERS)._jdf.queryExecution().optimizedPlan().toString()
    assert "raise_error" in text
