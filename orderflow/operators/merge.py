"""Merge a batch into the order table.

Two modes. The *reference* mode keeps the plain two-key match: a row without a
product never matches, so a delete whose lines are gone comes in as a live row.
The *repaired* mode (``merge_orders``) deletes by order, matches products
null-safe, and leaves an order alone when the batch is older than its rows.

The source has one row per (order, product), see ``staging``. The target is
always the left side, so a small source is broadcast to it and nothing of the
target is shuffled, and a large one is joined on (order, product), by which
even an order with a third of all lines spreads over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.merge import MergeIntoWriter

from orderflow.operators.joins import by_number
from orderflow.operators.staging import merge_conflicts
from orderflow.schemas import ORDERS
from orderflow.session import Settle, unsettled

LINE = ["salesorderid", "productid"]
# Taken over from the source unless it is a delete.
VALUES = ("orderdate", "productname", "postalcode", "productorderqty", "productsales")


def _as_source(source: DataFrame) -> DataFrame:
    """Columns under names of their own, and a mark that survives an outer join."""
    return source.select(
        *[F.col(name).alias(f"b_{name}") for name in source.columns], F.lit(1).alias("b_hit")
    )


def _inserted(rows: DataFrame, deleted_flg: int) -> DataFrame:
    return rows.withColumn("deleted_flg", F.lit(deleted_flg)).select(ORDERS.names)


# -- reference mode ---------------------------------------------------------


def _equal_keys() -> Column:
    return (F.col("salesorderid") == F.col("b_salesorderid")) & (
        F.col("productid") == F.col("b_productid")
    )


def _updated(hit: Column) -> list[Column]:
    """Target columns after the update of matched rows. A NULL operation is
    neither ``<> 'D'`` nor ``= 'D'``: values stay, the row is live."""
    op = F.col("b_sys_change_op")
    new = {name: F.when(hit & (op != "D"), F.col(f"b_{name}")).otherwise(F.col(name)) for name in VALUES}
    for name in ("orderupdatedtm", "src_cdt_batch_id"):
        new[name] = F.when(hit, F.col(f"b_{name}")).otherwise(F.col(name))
    new["deleted_flg"] = (
        F.when(hit & (op == "D"), 1).when(hit, 0).otherwise(F.col("deleted_flg"))
    )
    return [new.get(name, F.col(name)).alias(name) for name in ORDERS.names]


def merge_matched(target: DataFrame, source: DataFrame) -> DataFrame:
    """Only the target rows a source row matches, after the update."""
    return target.join(_as_source(source), _equal_keys()).select(_updated(F.lit(True)))


def merge_unmatched(target: DataFrame, source: DataFrame) -> DataFrame:
    """Source rows no target row matches, as live rows whatever their operation.
    The target's keys are first cut down to those in the source: there a small
    source can be broadcast, in the anti join it could not."""
    keys = target.select(LINE).join(source.select(LINE), LINE, "left_semi")
    return _inserted(source.join(keys, LINE, "left_anti"), 0)


def merge_orders_reference(target: DataFrame, source: DataFrame) -> DataFrame:
    kept = target.join(_as_source(source), _equal_keys(), "left").select(
        _updated(F.col("b_hit").isNotNull())
    )
    return kept.unionByName(merge_unmatched(target, source))


def assert_mergeable(target: DataFrame, source: DataFrame) -> None:
    """Fail, as a MERGE does, if a target row has several source rows. Runs a job."""
    twice = merge_conflicts(source).select(LINE)
    sample = target.select(LINE).join(twice, LINE, "left_semi").take(3)
    if sample:
        raise ValueError(f"several source rows for one target row, e.g. {sample}")


def assert_one_row_per_line(source: DataFrame) -> None:
    """Fail if a batch has several rows for one line, which the repaired merge,
    matching NULL products, too, would all put into the table. Runs a job."""
    sample = merge_conflicts(source, per_batch=True).take(3)
    if sample:
        raise ValueError(f"several source rows for one line, e.g. {sample}")


def merge_into_table(source: DataFrame, table: str) -> None:
    """The reference merge as a row-level MERGE, for catalogs that have one.
    Writes to the table."""
    reference_merge(source, table).merge()


def reference_merge(source: DataFrame, table: str) -> MergeIntoWriter:
    """The MERGE of the reference mode, not yet run."""
    old = {name: F.col(f"{table}.{name}") for name in ORDERS.names}
    b = {name: F.col(f"b.{name}") for name in source.columns}
    op = b["sys_change_op"]
    updates = {name: F.when(op != "D", b[name]).otherwise(old[name]) for name in VALUES}
    updates["orderupdatedtm"] = b["orderupdatedtm"]
    updates["src_cdt_batch_id"] = b["src_cdt_batch_id"]
    updates["deleted_flg"] = F.when(op == "D", 1).otherwise(0)
    inserts = {name: b[name] for name in ORDERS.names if name in b} | {"deleted_flg": F.lit(0)}
    match = (old["salesorderid"] == b["salesorderid"]) & (old["productid"] == b["productid"])
    merge = source.alias("b").mergeInto(table, match)
    return merge.whenMatched().update(updates).whenNotMatched().insert(inserts)


# -- repaired mode ----------------------------------------------------------


def _same_line(left: DataFrame, right: DataFrame) -> Column:
    return (left["salesorderid"] == right["salesorderid"]) & left["productid"].eqNullSafe(
        right["productid"]
    )


def incoming_orders(source: DataFrame) -> DataFrame:
    """One row per order in the source: its latest ``batch`` there, which holds
    all lines of the order, whether that ``is_delete``, and whether the order is
    ``mixed``: not all of its rows are of that batch and kind."""
    row = F.struct(F.col("src_cdt_batch_id").alias("batch"), _is_delete().alias("is_delete"))
    return (
        source.groupBy("salesorderid")
        .agg(F.max(row).alias("latest"), F.min(row).alias("least"))
        .select(
            "salesorderid",
            "latest.batch",
            "latest.is_delete",
            (~F.col("latest").eqNullSafe(F.col("least"))).alias("mixed"),
        )
    )


def _is_delete() -> Column:
    return F.when(F.col("sys_change_op") == "D", 1).otherwise(0)


def standing_lines(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Keys and batches of the target's lines of incoming orders: three columns
    of the target, the only scan of it beside the merge itself."""
    lines = target.select("salesorderid", "productid", "src_cdt_batch_id")
    return lines.join(incoming.select("salesorderid"), "salesorderid", "left_semi")


def order_verdicts(standing: DataFrame, incoming: DataFrame) -> DataFrame:
    """The incoming orders, with ``known`` (the target has rows of it) and
    ``stale`` (the target already has a later batch, so the order is left alone)."""
    per_order = standing.groupBy("salesorderid").agg(
        F.max("src_cdt_batch_id").alias("standing_batch"), F.lit(True).alias("known")
    )
    stale = F.coalesce(F.col("batch") < F.col("standing_batch"), F.lit(False))
    return incoming.join(per_order, "salesorderid", "left").select(
        *incoming.columns, F.coalesce("known", F.lit(False)).alias("known"), stale.alias("stale")
    )


def _deleted_lines(standing: DataFrame, deletes: DataFrame, with_lines: DataFrame) -> DataFrame:
    """A change for every standing line of the deleted orders. The time changes
    only where the delete came with that very line."""
    lines = (
        standing.join(deletes.select("salesorderid", "batch"), "salesorderid")
        .select("salesorderid", "productid", F.col("batch").alias("src_cdt_batch_id"))
        .distinct()
    )
    times = with_lines.select(
        "salesorderid", "productid", "orderupdatedtm", F.lit(1).alias("sets_time")
    )
    return lines.join(times, _same_line(lines, times), "left").select(
        lines["*"], "orderupdatedtm", "sets_time", F.lit(1).alias("is_delete")
    )


def _applied(source: DataFrame, odd: DataFrame) -> DataFrame:
    """The rows of the source that apply, with ``is_delete``. Of most orders all
    rows do and each row tells by itself; only the ``odd`` orders (mixed or stale)
    need their verdict. Where those are few they are broadcast, and the source is
    not shuffled to meet the verdicts of all its orders."""
    verdict = odd.select("salesorderid", "batch", "stale", F.col("is_delete").alias("verdict"))
    latest = ~F.col("stale") & F.col("src_cdt_batch_id").eqNullSafe(F.col("batch"))
    return (
        source.where(F.col("salesorderid").isNotNull())
        .join(verdict, "salesorderid", "left")
        .where(F.col("stale").isNull() | latest)
        .withColumn("is_delete", F.coalesce("verdict", _is_delete()))
        .drop("batch", "stale", "verdict")
    )


def _counted(step: DataFrame, made: DataFrame, rows: Column | None = None) -> DataFrame:
    """Rows of a step as the right side of a join: only few are broadcast. They are
    counted where ``made`` was written, else that would compute it once more."""
    some = step if rows is None else step.where(rows)
    return some if step is made else by_number(some, some.count())


def line_changes(
    target: DataFrame, source: DataFrame, settle: Settle = unsettled
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What a batch does to the target, line by line: the changes (upserts, and
    a row per standing line of a deleted order), the standing lines, the deletes.

    The source may hold several batches of an order; only the latest counts."""
    orders = incoming_orders(source)
    incoming = settle(orders, "incoming")
    standing = settle(standing_lines(target, _counted(incoming, orders)), "standing")
    odd = F.col("mixed") | F.col("stale")
    told = order_verdicts(standing, incoming).where((F.col("is_delete") == 1) | odd)
    verdicts = settle(told, "verdicts")
    gone = (F.col("is_delete") == 1) & ~F.col("stale")
    deletes = verdicts.where(gone)
    applied = _applied(source, _counted(verdicts, told, odd))
    with_lines = applied.where((F.col("is_delete") == 1) & F.col("productid").isNotNull())
    changes = (
        applied.where(F.col("is_delete") == 0)
        .withColumn("sets_time", F.lit(1))
        .unionByName(
            _deleted_lines(standing, _counted(verdicts, told, gone), with_lines),
            allowMissingColumns=True,
        )
    )
    # Written before it meets the target: the size of a join is not known
    # beforehand, and the whole target would be shuffled for a few changes.
    return settle(changes, "changes"), standing, deletes


def settle_first(settle: Settle) -> Settle:
    """For the merge into a table that has no rows (``no_orders``): only the verdicts
    are read more than once, and the changes meet nothing."""
    return lambda df, name: settle(df, name) if name == "verdicts" else df


def merge_orders(target: DataFrame, source: DataFrame, settle: Settle = unsettled) -> DataFrame:
    """The whole target after the merge.

    Deletes are turned into changes per line first, so that the target itself
    is joined once, on (order, product)."""
    changes, standing, deletes = line_changes(target, source, settle)
    b = _as_source(changes)
    on_line = (F.col("salesorderid") == F.col("b_salesorderid")) & F.col("productid").eqNullSafe(
        F.col("b_productid")
    )
    hit, upsert = F.col("b_hit").isNotNull(), F.col("b_is_delete") == 0
    new = {name: F.when(upsert, F.col(f"b_{name}")).otherwise(F.col(name)) for name in VALUES}
    new["orderupdatedtm"] = F.when(
        F.col("b_sets_time") == 1, F.col("b_orderupdatedtm")
    ).otherwise(F.col("orderupdatedtm"))
    new["src_cdt_batch_id"] = F.when(hit, F.col("b_src_cdt_batch_id")).otherwise(
        F.col("src_cdt_batch_id")
    )
    new["deleted_flg"] = F.coalesce("b_is_delete", "deleted_flg")
    kept = target.join(b, on_line, "left").select(
        [new.get(name, F.col(name)).alias(name) for name in ORDERS.names]
    )

    upserts, known = changes.where(F.col("is_delete") == 0), standing.select(LINE)
    inserted = _inserted(upserts.join(known, _same_line(upserts, known), "left_anti"), 0)
    return kept.unionByName(inserted).unionByName(tombstones(deletes))


def tombstones(deletes: DataFrame) -> DataFrame:
    """One flagged row per deleted order the target has never seen, so that an
    older batch that comes later is known to be stale."""
    values = {
        "salesorderid": F.col("salesorderid"),
        "src_cdt_batch_id": F.col("batch"),
        "deleted_flg": F.lit(1),
    }
    return deletes.where(~F.col("known")).select(
        [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ORDERS]
    )


def merge_source(target: DataFrame, source: DataFrame, settle: Settle = unsettled) -> DataFrame:
    """All that the repaired merge writes, as the source of a row-level MERGE:
    the changes per line, the tombstones, and ``action`` (upsert, delete, or
    delete with the time of the line)."""
    changes, _, deletes = line_changes(target, source, settle)
    action = (
        F.when(F.col("is_delete") == 0, "upsert")
        .when(F.col("sets_time") == 1, "delete at")
        .otherwise("delete")
    )
    lines = changes.withColumn("action", action)
    unseen = tombstones(deletes).drop("deleted_flg").withColumn("action", F.lit("tombstone"))
    columns = [*(n for n in ORDERS.names if n != "deleted_flg"), "action"]
    return lines.select(columns).unionByName(unseen.select(columns))


def repaired_merge(changes: DataFrame, table: str) -> MergeIntoWriter:
    """The MERGE of the repaired mode, not yet run: one clause per action, so that
    only rows that change are rewritten. ``changes`` come from ``merge_source``."""
    old = {name: F.col(f"{table}.{name}") for name in ORDERS.names}
    b = {name: F.col(f"b.{name}") for name in changes.columns}
    match = (old["salesorderid"] == b["salesorderid"]) & old["productid"].eqNullSafe(b["productid"])
    deleted = {"src_cdt_batch_id": b["src_cdt_batch_id"], "deleted_flg": F.lit(1)}
    upserted = {n: b[n] for n in ORDERS.names if n in b} | {"deleted_flg": F.lit(0)}
    buried = upserted | {"deleted_flg": F.lit(1)}
    return (
        changes.alias("b")
        .mergeInto(table, match)
        .whenMatched(b["action"] == "upsert")
        .update(upserted)
        .whenMatched(b["action"] == "delete at")
        .update(deleted | {"orderupdatedtm": b["orderupdatedtm"]})
        .whenMatched(b["action"] == "delete")
        .update(deleted)
        .whenNotMatched(b["action"] == "upsert")
        .insert(upserted)
        .whenNotMatched(b["action"] == "tombstone")
        .insert(buried)
    )
