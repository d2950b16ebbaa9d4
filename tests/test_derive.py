from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from orderflow.operators import domains, nested, terms
from tests.rows import bag, dicts


def test_terms(spark):
    df = spark.createDataFrame(
        [(1, datetime(2020, 2, 20, 13, 5), 1000.0)], "k long, orderdate timestamp_ntz, subtotal double"
    )
    row = dicts(terms.order_terms(df))[0]
    assert row["orderdate"] == datetime(2020, 2, 20)
    assert row["duedate"] == datetime(2020, 3, 6)
    assert row["shipdate"] == datetime(2020, 2, 27)
    assert row["taxamt"] == Decimal("78.9800")
    assert (row["status"], row["onlineorderflag"], row["shipmethodid"], row["revisionnumber"]) == (5, 0, 1, 8)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 10**10), min_size=1, max_size=20))
def test_numbers_are_padded_and_never_cut(spark, numbers):
    df = spark.createDataFrame([(n, n, n) for n in numbers], "ponumber long, branch long, serial long")
    for row in terms.document_numbers(df).collect():
        assert row.purchaseordernumber == f"PO{row.ponumber:08d}"
        assert row.accountnumber == f"10-{row.branch:04d}-{row.serial:06d}"


def test_prices(spark):
    df = spark.createDataFrame([(2000, 0.126), (59999, 0.1)], "pricecents long, discount double")
    found = [(r.unitprice, r.unitpricediscount) for r in terms.unit_prices(df).collect()]
    assert found == [(Decimal("20.00"), 0.13), (Decimal("599.99"), 0.1)]


def test_split_carries_the_key_and_keeps_line_less_headers(spark, tmp_path):
    orders = spark.createDataFrame(
        [(1, "a", [(5, 2), (6, 3)]), (1, "a", [(5, 2)]), (2, "b", []), (3, "c", None)],
        "salesorderid long, who string, orderdetails array<struct<productid: long, qty: int>>",
    )
    headers, lines = nested.split_orders(orders, str(tmp_path / "split"))
    assert bag(headers) == [(1, "a"), (2, "b"), (3, "c")]
    assert bag(lines) == [(5, 2, 1), (5, 2, 1), (6, 3, 1)]


def test_domains(spark):
    persons = spark.createDataFrame(
        [("A", "X", 1), ("A", "Y", 2), ("A", "X", 1)],
        "firstname string, lastname string, businessentityid long",
    )
    addresses = spark.createDataFrame(
        [("s", "c", "1"), ("s", "c", "1"), ("s", None, "2")],
        "addressline1 string, city string, postalcode string",
    )
    assert bag(domains.distinct_persons(persons)) == [(1, "A", "X"), (2, "A", "Y")]
    assert len(bag(domains.distinct_addresses(addresses))) == 2
    assert bag(domains.column_domains(persons, addresses)) == sorted(
        [
            ("firstname", "A"), ("lastname", "X"), ("lastname", "Y"), ("businessentityid", "1"),
            ("businessentityid", "2"), ("addressline1", "s"), ("city", "c"), ("city", None),
            ("postalcode", "1"), ("postalcode", "2"),
        ],
        key=repr,
    )
