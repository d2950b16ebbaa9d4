"""Typed rows to all-text wire rows and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions.text import as_text, unreadable, without_null_text
from orderflow.schemas import STAGING, WIRE

# Staging column -> wire field.
WIRE_FIELD = {
    "salesorderid": "salesorderid",
    "productid": "ProductID",
    "orderdate": "OrderDate",
    "productname": "productname",
    "postalcode": "PostalCode",
    "productorderqty": "productorderqty",
    "productsales": "productsales",
    "sys_change_op": "sys_change_op",
    "orderupdatedtm": "orderupdatedtm",
    "src_cdt_batch_id": "job_exec_id",
}


def stringify_wire(captured: DataFrame) -> DataFrame:
    return captured.select([as_text(name) for name in WIRE.names])


def _raw(name: str, null_text: str | None) -> Column:
    return without_null_text(F.col(WIRE_FIELD[name]), null_text)


def parse_wire(wire: DataFrame, null_text: str | None = None) -> DataFrame:
    """Staging rows. A value that does not fit its type fails the job (ANSI
    casts); ``null_text`` is the word old files hold for NULL."""
    return wire.select(
        [_raw(f.name, null_text).cast(f.dataType).alias(f.name) for f in STAGING]
    )


def parse_wire_variant(lines: DataFrame, null_text: str | None = None) -> DataFrame:
    """Staging rows from whole lines (``value``), by paths into a VARIANT, so that
    fields beyond the wire's pass through the stage unharmed; those are kept in
    ``more`` as JSON, NULL if there are none. A value of another JSON type than
    text is taken in its text form."""
    known = lines.select(F.parse_json("value").alias("v"))
    field = lambda name: without_null_text(
        F.variant_get("v", f"$.{WIRE_FIELD[name]}", "string"), null_text
    )
    fields = F.from_json(F.to_json("v"), "map<string, string>")
    more = F.map_filter(fields, lambda name, _: ~name.isin(*WIRE.names))
    return known.select(
        *[field(f.name).cast(f.dataType).alias(f.name) for f in STAGING],
        F.when(F.size(more) > 0, F.to_json(more)).alias("more"),
    )


# -- lines that cannot be loaded --------------------------------------------------

CORRUPT = "_corrupt_record"
# The order a broken line speaks of, if that much of it can be read.
_ORDER_IN_TEXT = r'"salesorderid"\s*:\s*"?(-?\d+)"?\s*[,}]'


def judge_wire(lines: DataFrame, null_text: str | None = None) -> DataFrame:
    """Wire lines with ``problem`` (NULL if the line can be loaded) and ``about``,
    the order it belongs to, which even of a broken line can often be read.
    ``lines`` may have a column with the text of those that are no JSON."""
    if CORRUPT not in lines.columns:
        lines = lines.withColumn(CORRUPT, F.lit(None).cast("string"))
    broken = F.col(CORRUPT).isNotNull()
    value = lambda f: _raw(f.name, null_text)
    problems = [
        F.when(broken, "not JSON"),
        F.when(value(STAGING["salesorderid"]).isNull(), "no order"),
        F.when(value(STAGING["src_cdt_batch_id"]).isNull(), "no batch"),
        F.when(~value(STAGING["sys_change_op"]).isin("I", "U", "D"), "unknown operation"),
        *[F.when(unreadable(value(f), f.dataType), f"unreadable {f.name}") for f in STAGING],
    ]
    read = F.regexp_extract(CORRUPT, _ORDER_IN_TEXT, 1).try_cast("bigint")
    about = F.when(broken, read).otherwise(value(STAGING["salesorderid"]).try_cast("bigint"))
    return lines.withColumn("problem", F.coalesce(*problems)).withColumn("about", about)


def split_wire(judged: DataFrame, null_text: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Staging rows of the orders whose lines can all be loaded, and all lines of
    the others: half an order would be merged as a whole one. ``judged`` is read
    several times, so it should be settled; its ``batch``, if it has one, tells
    apart what several batches say of an order."""
    scope = ["about", *(["batch"] if "batch" in judged.columns else [])]
    wrong = judged.where(F.col("problem").isNotNull())
    orders = wrong.where(F.col("about").isNotNull()).select(scope).distinct()
    fine = judged.where(F.col("problem").isNull())
    good = fine.join(orders, scope, "left_anti").select(
        [_raw(f.name, null_text).try_cast(f.dataType).alias(f.name) for f in STAGING]
    )
    beside = fine.join(orders, scope, "left_semi").withColumn(
        "problem", F.lit("another line of the order")
    )
    return good, wrong.unionByName(beside)


def orderless(judged: DataFrame) -> DataFrame:
    """Lines that cannot be loaded and do not tell whose they are: some order of
    their batch lacks a line, and nobody knows which."""
    return judged.where(F.col("problem").isNotNull() & F.col("about").isNull())
