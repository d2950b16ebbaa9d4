"""Schemas as constraints: what a row must be to be written.

The checks are expressions in the plan of the write itself, so they cost no pass
of their own. A row that breaks one stops the write and is named by its key.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.schemas import LEDGER, ORDER_SUMMARY, ORDERS, STAGING, assert_schema


@dataclass(frozen=True)
class Constraints:
    """``key`` names a row in errors; ``rules`` are SQL conditions by name. A
    condition that is NULL holds, as in a CHECK; ``required`` are not null."""

    schema: T.StructType
    key: tuple[str, ...]
    required: tuple[str, ...]
    rules: tuple[tuple[str, str], ...] = ()

    def conditions(self) -> dict[str, Column]:
        found = {f"{c} is null": F.col(c).isNotNull() for c in self.required}
        return found | {name: F.coalesce(F.expr(sql), F.lit(True)) for name, sql in self.rules}


# Operations, flags and hours that exist.
OF_STAGING = Constraints(
    STAGING,
    ("salesorderid", "productid", "src_cdt_batch_id"),
    ("salesorderid", "src_cdt_batch_id"),
    (("unknown operation", "sys_change_op in ('I', 'U', 'D')"),),
)
OF_ORDERS = Constraints(
    ORDERS,
    ("salesorderid", "productid"),
    ("salesorderid",),
    (("flag is neither 0 nor 1", "deleted_flg in (0, 1)"),),
)
OF_LEDGER = Constraints(
    LEDGER,
    ("job_exec_id",),
    ("job_exec_id",),
    (
        ("negative version", "db_chg_version_id >= 0"),
        ("a job that has ended needs a status", "job_end_ts is null or job_exec_status is not null"),
    ),
)
OF_SUMMARY = Constraints(
    ORDER_SUMMARY,
    ("orderdate", "orderhour", "productid"),
    (),
    (("no hour of the day", "orderhour between 0 and 23"),),
)


def broken_rules(rules: Constraints) -> Column:
    """The names of the rules a row breaks, NULL if it breaks none."""
    names = [F.when(~holds, F.lit(name)) for name, holds in rules.conditions().items()]
    return F.nullif(F.concat_ws("; ", *names), F.lit(""))


def violations(rows: DataFrame, rules: Constraints) -> DataFrame:
    """The key of each row that may not be written, and why."""
    return rows.select(*rules.key, broken_rules(rules).alias("broken")).where("broken is not null")


def enforced(rows: DataFrame, rules: Constraints) -> DataFrame:
    """The rows in the order of the schema. The check sits in a column that every
    write needs, so that no optimizer can leave it out."""
    rows = assert_schema(rows, rules.schema)
    holds = reduce(and_, rules.conditions().values())
    key = F.to_json(F.struct(*rules.key), {"ignoreNullFields": "false"})
    error = F.concat(F.lit("row may not be written ("), broken_rules(rules), F.lit("): "), key)
    first = rules.key[0]
    kind = rules.schema[first].dataType
    return rows.withColumn(first, F.when(holds, F.col(first)).otherwise(F.raise_error(error).cast(kind)))
