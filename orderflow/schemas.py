"""Schemas at rest. They are declared, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_LONG, _INT, _TEXT = T.LongType(), T.IntegerType(), T.StringType()
_NTZ, _DATE, _DOUBLE = T.TimestampNTZType(), T.DateType(), T.DoubleType()

# The wire's field names, mixed case included. JSON field names
# are matched by exact case, so they may not be tidied up.
WIRE = _struct(
    ("salesorderid", _TEXT),
    ("sys_change_op", _TEXT),
    ("OrderDate", _TEXT),
    ("orderupdatedtm", _TEXT),
    ("ProductID", _TEXT),
    ("productname", _TEXT),
    ("PostalCode", _TEXT),
    ("productorderqty", _TEXT),
    ("productsales", _TEXT),
    ("job_exec_id", _TEXT),
)

STAGING = _struct(
    ("salesorderid", _LONG),
    ("productid", _LONG),
    ("orderdate", _DATE),
    ("productname", _TEXT),
    ("postalcode", _TEXT),
    ("productorderqty", _LONG),
    ("productsales", _DOUBLE),
    ("sys_change_op", _TEXT),
    ("orderupdatedtm", _NTZ),
    ("src_cdt_batch_id", _LONG),
)

ORDERS = _struct(
    ("salesorderid", _LONG),
    ("productid", _LONG),
    ("orderdate", _DATE),
    ("productname", _TEXT),
    ("postalcode", _TEXT),
    ("productorderqty", _LONG),
    ("productsales", _DOUBLE),
    ("orderupdatedtm", _NTZ),
    ("src_cdt_batch_id", _LONG),
    ("deleted_flg", _INT),
)

LEDGER = _struct(
    ("job_exec_id", _LONG),
    ("job_exec_status", _INT),
    ("db_chg_version_id", _LONG),
    ("job_start_ts", _NTZ),
    ("job_end_ts", _NTZ),
)

ORDER_SUMMARY = _struct(
    ("orderdate", _DATE),
    ("orderhour", _INT),
    ("productid", _LONG),
    ("productname", _TEXT),
    ("postalcode", _TEXT),
    ("productsalesvolume", _LONG),
    ("productsales", _DOUBLE),
)

# Versions of keys that changed; ``changed_at`` serves retention.
CHANGE_LOG = _struct(
    ("salesorderid", _LONG),
    ("version", _LONG),
    ("op", _TEXT),
    ("changed_at", _NTZ),
)

# One row per capture batch whose lines are all in the stage.
READY = _struct(("job_exec_id", _LONG), ("row_count", _LONG))


def assert_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """The frame in the expected column order, or an error naming the
    columns that are missing, superfluous or of another type."""
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in expected}
    if have != want:
        wrong = sorted(set(have.items()) ^ set(want.items()), key=lambda x: x[0])
        raise ValueError(f"schema mismatch: {[(n, t.simpleString()) for n, t in wrong]}")
    return df.select(*want)
