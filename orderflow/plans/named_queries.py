"""One named query per operator, over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators import (
    capture,
    changes,
    domains,
    keys,
    ledger,
    merge,
    nested,
    staging,
    summary,
    terms,
    wire,
)
from orderflow.operators.constraints import OF_LEDGER, violations
from orderflow.plans import runs
from orderflow.plans.sample_tables import BEFORE_DELETES, FIRST, SECOND, SampleTables
from orderflow.schemas import ORDER_SUMMARY, STAGING
from orderflow.session import PACKING, configure, settle_into, shared_dir
from orderflow.sources.change_log import ChangeLog
from orderflow.sources.orders_table import OrdersTable, no_orders
from orderflow.sources.stage import Stage, read_lines, ready_batches, write_wire
from orderflow.sources.stage import short_batches as find_short_batches
from orderflow.streaming.load_stream import start_load_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The clock of the queries.
NOW = datetime(2025, 1, 1, 12, 0, 0)
# Versions that exist: the last delete happens at 99.
LAST_VERSION = 99
TABLE_BUCKETS = 16
FILES_PER_TRIGGER = 64
# Lines of text are most of what a run writes.
STAGE_PACKING = "gzip"


def _query(body: Callable[[SampleTables], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return body(SampleTables(configure(spark), sf_dir))

    QUERIES[body.__name__] = run
    return run


def _captured(t: SampleTables, span: tuple[int, int], batch_id: int, state: int | None = None):
    """The capture of a version range, the source being at ``state``."""
    since, until = span
    state = until if state is None else state
    net = changes.net_changes(t.change_log(), since, until)
    return capture.capture_orders(
        net, t.header(state), t.detail(state), t.product(), t.address(), batch_id, _settle(t)
    )


def _staged(t: SampleTables, span: tuple[int, int], batch_id: int, state: int | None = None):
    """Staging rows of a capture, without the way through the stage."""
    captured = _captured(t, span, batch_id, state)
    return captured.select(
        [F.col(wire.WIRE_FIELD[f.name]).cast(f.dataType).alias(f.name) for f in STAGING]
    )


def _source(t: SampleTables, span: tuple[int, int], batch_id: int, state: int | None = None):
    return staging.stage_preagg(_staged(t, span, batch_id, state))


def _both_sources(t: SampleTables) -> DataFrame:
    return _source(t, FIRST, 1).unionByName(_source(t, SECOND, 2))


def _no_orders(t: SampleTables) -> DataFrame:
    return no_orders(t.spark)


def _first_merge(t: SampleTables, source: DataFrame, settle) -> DataFrame:
    return merge.merge_orders(_no_orders(t), source, merge.settle_first(settle))


def _after_first(t: SampleTables, settle) -> DataFrame:
    source = settle(_source(t, FIRST, 1), "source1")
    return settle(_first_merge(t, source, settle), "orders_v1")


def _settle(t: SampleTables):
    return settle_into(shared_dir(t.spark), PACKING)


# -- changes ------------------------------------------------------------------


@_query
def net_changes_since(t):
    return changes.net_changes(t.change_log(), SECOND[0])


@_query
def net_changes_between(t):
    return changes.net_changes(t.change_log(), 30, 95)


@_query
def net_changes_of_log(t):
    """From a log at rest, of which only the partitions of the range are read."""
    log = t.log_at_rest().between(t.spark, *SECOND)
    return changes.net_changes(log, *SECOND)


def _mark(t):
    """The version of the last success among the first jobs."""
    return ledger.last_success_version(t.ledger().where("db_chg_version_id between 40 and 69"))


@_query
def net_changes_after_mark(t):
    """Since the last success, ledger and log read by one query."""
    return changes.net_changes(t.log_at_rest().after(_mark(t)), 0)


@_query
def net_changes_of_keys(t):
    """From a feed with one row per key."""
    return changes.net_changes_of_keys(changes.keys_of_log(t.change_log()), SECOND[0])


@_query
def newest_version_of_log(t):
    return t.log_at_rest().newest_version(t.spark)


@_query
def cleaned_log(t):
    """What is left of a log at rest after its retention."""
    log = ChangeLog(f"{shared_dir(t.spark)}/log", versions_per_part=100)
    log.append(t.event_log())
    log.clean(t.spark, _newest_event(t))
    return log.read(t.spark).select("salesorderid", "version", "op", "changed_at")


@_query
def current_version(t):
    return changes.current_version(t.change_log())


def _newest_event(t) -> datetime:
    return t.event_log().agg(F.max("changed_at")).first()[0]


@_query
def change_log_retention(t):
    return changes.retained_changes(t.event_log(), _newest_event(t))


@_query
def min_valid_version(t):
    return changes.min_valid_version(t.event_log(), _newest_event(t))


# -- capture ------------------------------------------------------------------


@_query
def join_changes_header(t):
    net = changes.net_changes(t.change_log(), *SECOND)
    return capture.join_changes_header(net, t.header(SECOND[1]))


@_query
def join_changes_detail(t):
    net = _settle(t)(changes.net_changes(t.change_log(), *SECOND), "net_changes")
    lines = capture.join_changes_detail(net, t.detail(SECOND[1]))
    return lines.withColumn("productsales", F.col("productsales").cast("double"))


@_query
def capture_orders(t):
    rows = _captured(t, SECOND, 2)
    return rows.withColumn("productsales", F.col("productsales").cast("double"))


@_query
def capture_all_orders(t):
    rows = _captured(t, FIRST, 1)
    return rows.withColumn("productsales", F.col("productsales").cast("double"))


@_query
def count_by_op(t):
    return capture.count_by_op(_captured(t, SECOND, 2))


@_query
def count_by_op_total(t):
    return capture.count_by_op_total(_captured(t, SECOND, 2))


# -- wire and staging -----------------------------------------------------------


@_query
def stringify_wire(t):
    return wire.stringify_wire(_captured(t, SECOND, 2))


@_query
def parse_wire(t):
    return wire.parse_wire(wire.stringify_wire(_captured(t, SECOND, 2)))


@_query
def copy_to_stage(t):
    """Through JSON files of a stage and back."""
    stage = Stage(shared_dir(t.spark), STAGE_PACKING)
    write_wire(_captured(t, SECOND, 2), stage, 2)
    return runs.copy_to_stage(read_lines(t.spark, stage, [2]), _settle(t))[0]


@_query
def parse_wire_variant(t):
    """Whole lines, some with a field more, as they came."""
    wired = wire.stringify_wire(_captured(t, SECOND, 2))
    odd = F.when(F.col("salesorderid").cast("bigint") % 5 == 0, "blue").alias("colour")
    return wire.parse_wire_variant(wired.select(F.to_json(F.struct(*wired.columns, odd)).alias("value")))


def _judged(t):
    """A batch of which some lines are broken, judged line by line."""
    root = shared_dir(t.spark)
    stage, settle = Stage(f"{root}/stage", STAGE_PACKING), settle_into(root)
    t.break_lines(settle(_captured(t, SECOND, 2), "captured"), stage, 2)
    lines = read_lines(t.spark, stage, [2], strict=False)
    return settle(wire.judge_wire(lines), "judged")


@_query
def quarantine_rows(t):
    """Lines set aside, by order and reason."""
    bad = wire.split_wire(_judged(t))[1]
    return bad.groupBy("batch", F.col("about").alias("salesorderid"), "problem").agg(
        F.count(F.lit(1)).alias("line_count")
    )


@_query
def quarantine_loaded(t):
    """Orders whose lines are all whole."""
    return wire.split_wire(_judged(t))[0]


@_query
def short_batches(t):
    """Two batches, of the second only the lines of every other order arrived."""
    stage = Stage(shared_dir(t.spark), STAGE_PACKING)
    write_wire(_captured(t, FIRST, 1), stage, 1)
    second = _settle(t)(_captured(t, SECOND, 2), "second")
    write_wire(second, stage, 2)
    some = wire.stringify_wire(second.where("salesorderid % 2 = 0"))
    some.write.mode("overwrite").json(stage.batch_path(2), compression=stage.compression)
    return find_short_batches(t.spark, stage)


@_query
def quantity_overflows(t):
    """Quantities so large that two of them are too many."""
    large = F.col("productorderqty") * F.lit(1 << 57)
    return staging.quantity_overflows(_staged(t, FIRST, 1).withColumn("productorderqty", large))


@_query
def ledger_violations(t):
    """Jobs that ended without a status may not be noted."""
    ended = t.ledger().withColumn("job_end_ts", F.col("job_start_ts"))
    return violations(ended, OF_LEDGER)


@_query
def ready_batch_counts(t):
    stage = Stage(shared_dir(t.spark), STAGE_PACKING)
    write_wire(_captured(t, FIRST, 1), stage, 1)
    write_wire(_captured(t, SECOND, 2), stage, 2)
    return ready_batches(t.spark, stage)


@_query
def stage_preagg(t):
    return _source(t, FIRST, 1)


@_query
def latest_batch_per_order(t):
    # Settled, as the operator reads its rows twice.
    return staging.latest_batch_per_order(_settle(t)(_both_sources(t), "both"))


@_query
def merge_conflicts(t):
    return staging.merge_conflicts(_both_sources(t))


# -- merge ----------------------------------------------------------------------


@_query
def merge_orders_reference(t):
    """Batch 1 into an empty table, then batch 2."""
    settle = _settle(t)
    first = settle(
        merge.merge_orders_reference(_no_orders(t), _source(t, FIRST, 1)), "reference_v1"
    )
    return merge.merge_orders_reference(first, settle(_source(t, SECOND, 2), "source2"))


def _matching_merge(t):
    """Batch 2 taken while deleted orders still have their lines, so that
    deletes match on (order, product) as well."""
    settle = _settle(t)
    return _after_first(t, settle), settle(_source(t, SECOND, 2, BEFORE_DELETES), "source2")


@_query
def merge_matched_update(t):
    return merge.merge_matched(*_matching_merge(t)).drop("deleted_flg")


@_query
def merge_soft_delete(t):
    return merge.merge_matched(*_matching_merge(t)).select(
        "salesorderid", "productid", "src_cdt_batch_id", "deleted_flg"
    )


@_query
def merge_insert_new(t):
    settle = _settle(t)
    return merge.merge_unmatched(_after_first(t, settle), settle(_source(t, SECOND, 2), "source2"))


@_query
def merge_orders(t):
    settle = _settle(t)
    first = _after_first(t, settle)
    return merge.merge_orders(first, settle(_source(t, SECOND, 2), "source2"), settle)


@_query
def merge_orders_with_lines(t):
    """Repaired merge of deletes that still have their lines."""
    return merge.merge_orders(*_matching_merge(t), _settle(t))


@_query
def merge_actions(t):
    """What a row-level MERGE is given to write."""
    return merge.merge_source(*_matching_merge(t), _settle(t))


@_query
def merge_ignores_stale(t):
    """Batch 2 first, then batch 1, which must not undo it."""
    settle = _settle(t)
    source = settle(_source(t, SECOND, 2), "source2")
    newer = settle(_first_merge(t, source, settle), "orders_v2")
    return merge.merge_orders(newer, settle(_source(t, FIRST, 1), "source1"), settle)


@_query
def merge_both_batches(t):
    """Both batches staged in one load."""
    settle = _settle(t)
    return _first_merge(t, settle(_both_sources(t), "both"), settle)


# -- summary ----------------------------------------------------------------------


@_query
def live_orders(t):
    settle = _settle(t)
    source = settle(_source(t, SECOND, 2), "source2")
    merged = merge.merge_orders(_after_first(t, settle), source, settle)
    return summary.live_orders(merged)


@_query
def order_summary(t):
    settle = _settle(t)
    source = settle(_source(t, SECOND, 2), "source2")
    merged = merge.merge_orders(_after_first(t, settle), source, settle)
    return summary.order_summary(merged)


@_query
def order_summary_table(t):
    """The summary of the first load, written and read."""
    path = f"{shared_dir(t.spark)}/summary"
    runs.write_summary(_after_first(t, _settle(t)), path)
    return t.spark.read.schema(ORDER_SUMMARY).parquet(path)


@_query
def order_summary_first_load(t):
    """From the change log to the summary."""
    return summary.order_summary(_after_first(t, _settle(t)))


# -- whole runs ---------------------------------------------------------------------


def _stage_and_table(t: SampleTables) -> tuple[str, Stage, OrdersTable]:
    """Empty ones, the table cut into a fixed number of buckets."""
    root = shared_dir(t.spark)
    highest = t.table("orders").agg(F.max("o_orderkey")).first()[0]
    table = OrdersTable(f"{root}/orders", orders_per_bucket=highest // TABLE_BUCKETS + 1)
    return root, Stage(f"{root}/stage", STAGE_PACKING), table


def _capture_and_load(t: SampleTables, mode: str) -> DataFrame:
    """Capture, load, capture, load: through ledger, stage and table."""
    root, stage, table = _stage_and_table(t)
    for until in (FIRST[1], LAST_VERSION):
        runs.run_capture(t.spark, t.sources(until), f"{root}/ledger", stage, NOW)
        runs.run_load(t.spark, stage, table, mode=mode)
    return table.read(t.spark)


@_query
def load_run(t):
    return _capture_and_load(t, "repaired")


@_query
def load_run_reference(t):
    return _capture_and_load(t, "reference")


@_query
def load_stream(t):
    """Two captures, then the stream, a few files per micro-batch."""
    root, stage, table = _stage_and_table(t)
    for until in (FIRST[1], LAST_VERSION):
        runs.run_capture(t.spark, t.sources(until), f"{root}/ledger", stage, NOW)
    start_load_stream(
        t.spark, stage, table, f"{root}/checkpoint", files_per_trigger=FILES_PER_TRIGGER
    ).awaitTermination()
    return table.read(t.spark)


# -- ledger -------------------------------------------------------------------------


@_query
def last_success_version(t):
    return ledger.last_success_version(t.ledger())


@_query
def last_success_version_empty(t):
    """No run has succeeded yet: every job of the ledger failed."""
    none = F.when(F.col("job_exec_id") < 0, 0).cast("int")
    return ledger.last_success_version(t.ledger().withColumn("job_exec_status", none))


@_query
def ledger_start(t):
    events = t.ledger()
    version = changes.current_version(t.change_log()).first()["version"]
    return events.unionByName(ledger.ledger_start(events, version, NOW))


@_query
def ledger_end(t):
    """The latest unfinished job ends."""
    events = t.ledger()
    unfinished = events.where(F.col("job_exec_status").isNull())
    job = unfinished.agg(F.max("job_exec_id")).first()[0]
    return ledger.ledger_current(events.unionByName(ledger.ledger_end(events, job, NOW)))


# -- derivations ----------------------------------------------------------------------


@_query
def distinct_persons(t):
    return domains.distinct_persons(t.persons())


@_query
def distinct_addresses(t):
    return domains.distinct_addresses(t.person_addresses())


@_query
def column_domains(t):
    return domains.column_domains(t.persons(), t.person_addresses())


@_query
def key_domains(t):
    offers = t.table("lineitem").select(
        F.col("l_partkey").alias("productid"), F.col("l_suppkey").alias("specialofferid")
    )
    return domains.key_domains(
        t.table("nation").select(F.col("n_nationkey").alias("stateprovinceid")),
        t.address(),
        t.table("customer").select(F.col("c_custkey").alias("customerid")),
        offers.distinct(),
    )


@_query
def assign_keys(t):
    customer = t.table("customer")
    start = customer.agg(F.max("c_custkey")).first()[0]
    rows = customer.select("c_mktsegment", "c_name")
    return keys.assign_keys(rows, ["c_mktsegment", "c_name"], "businessentityid", start)


@_query
def assign_order_keys(t):
    """Keys for orders, after the highest order key."""
    orders = t.table("orders")
    start = orders.agg(F.max("o_orderkey")).first()[0]
    rows = orders.select("o_orderdate", "o_orderkey")
    return keys.assign_keys(rows, ["o_orderdate", "o_orderkey"], "salesorderid", start)


@_query
def split_order_headers(t):
    return nested.split_orders(t.nested_orders(), shared_dir(t.spark))[0]


@_query
def split_order_details(t):
    return nested.split_orders(t.nested_orders(), shared_dir(t.spark))[1]


@_query
def order_terms(t):
    orders = t.table("orders").select(
        F.col("o_orderkey").alias("salesorderid"),
        F.col("o_orderdate").alias("orderdate"),
        F.col("o_totalprice").alias("subtotal"),
    )
    return terms.order_terms(orders).withColumn("taxamt", F.col("taxamt").cast("double"))


@_query
def document_numbers(t):
    orders = t.table("orders").select(
        F.col("o_orderkey").alias("ponumber"),
        (F.col("o_custkey") % 10_000).alias("branch"),
        (F.col("o_orderkey") % 1_000_000).alias("serial"),
    )
    return terms.document_numbers(orders)


@_query
def unit_prices(t):
    lines = t.table("lineitem").select(
        F.col("l_orderkey").alias("salesorderid"),
        F.col("l_partkey").alias("productid"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("pricecents"),
        F.col("l_discount").alias("discount"),
    )
    return terms.unit_prices(lines).withColumn("unitprice", F.col("unitprice").cast("double"))
