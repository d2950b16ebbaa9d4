"""Hand-written rows for the rule tests."""

from __future__ import annotations

from datetime import date, datetime

from orderflow.schemas import LEDGER, ORDERS, STAGING, WIRE

DAY, TIME = date(2020, 1, 1), datetime(2020, 1, 1, 5, 6, 7)


def log(spark, *rows):
    return spark.createDataFrame(list(rows), "salesorderid long, version long, op string")


def source_row(order, product, batch=1, op="I", qty=1, sales=1.0, **other):
    row = dict.fromkeys(STAGING.names)
    if op != "D" or product is not None:
        row |= {"orderdate": DAY, "postalcode": "00001", "orderupdatedtm": TIME}
    if product is not None:
        row |= {"productname": f"p{product}", "productorderqty": qty, "productsales": sales}
    row |= {"salesorderid": order, "productid": product, "sys_change_op": op}
    return row | {"src_cdt_batch_id": batch} | other


def source(spark, *rows):
    return spark.createDataFrame([tuple(r[n] for n in STAGING.names) for r in rows], STAGING)


def order_row(order, product, batch=1, flag=0, **other):
    row = source_row(order, product, batch) | {"deleted_flg": flag} | other
    return {n: row[n] for n in ORDERS.names}


def orders(spark, *rows):
    return spark.createDataFrame([tuple(r[n] for n in ORDERS.names) for r in rows], ORDERS)


def ledger(spark, *rows):
    return spark.createDataFrame(list(rows), LEDGER)


def wire(spark, *rows):
    return spark.createDataFrame([tuple(r.get(n) for n in WIRE.names) for r in rows], WIRE)


def dicts(df):
    return [r.asDict() for r in df.collect()]


def by_key(df, *keys):
    """Rows by key; fails on a repeated key."""
    found = {}
    for row in dicts(df):
        key = tuple(row[k] for k in keys)
        assert key not in found, f"{key} twice"
        found[key] = row
    return found


def bag(df):
    names = sorted(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
