"""The two runs: capture changes to the stage, load the stage into the table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators.capture import capture_orders
from orderflow.operators.changes import assert_version_valid, current_version, net_changes
from orderflow.operators.constraints import OF_STAGING, OF_SUMMARY, enforced
from orderflow.operators.merge import (
    assert_mergeable,
    assert_one_row_per_line,
    merge_orders,
    merge_orders_reference,
    settle_first,
)
from orderflow.operators.staging import LINES, stage_preagg
from orderflow.operators.summary import order_summary
from orderflow.operators.wire import judge_wire, orderless, parse_wire, split_wire
from orderflow.session import PACKING, Settle, configure, settle_into
from orderflow.sources.change_log import ChangeLog
from orderflow.sources.ledger_log import close_job, high_water_mark, open_job
from orderflow.sources.orders_table import OrdersTable
from orderflow.sources.paths import drop_directory
from orderflow.sources.stage import (
    Stage,
    purge_batches,
    read_lines,
    ready_batches,
    sweep_unfinished,
    write_wire,
)
from orderflow.sources.tables import SourceTables


@dataclass(frozen=True)
class Captured:
    batch_id: int
    since: int
    until: int
    counts: dict[str, int]


def run_capture(
    spark: SparkSession,
    tables: SourceTables,
    ledger: str,
    stage: Stage,
    now: datetime,
    oldest_version: int = 0,
) -> Captured:
    """Capture what changed since the last successful run.

    The range ends at the version read at the start. The job is closed only
    after the batch is in the stage; if the run fails before that, the next one
    reads its range again and clears away what was left. A range of which changes
    have been cleaned up is refused: a log at rest knows that itself, for a frame
    ``oldest_version`` tells. One capture runs at a time.
    """
    configure(spark)
    log = tables.change_log
    at_rest = isinstance(log, ChangeLog)
    until = log.current_version(spark) if at_rest else current_version(log).first()["version"]
    since = high_water_mark(spark, ledger)
    assert_version_valid(since, log.min_valid_version(spark) if at_rest else oldest_version)
    batch_id = open_job(spark, ledger, until, now)
    sweep_unfinished(spark, stage, batch_id)

    work = f"{stage.root}/work/batch={batch_id}"
    settle = settle_into(work, PACKING)
    changes = log.between(spark, since, until) if at_rest else log
    net = settle(net_changes(changes, since, until), "net_changes")
    tables = tables.of_changes(net)
    captured = capture_orders(
        net, tables.header, tables.detail, tables.product, tables.address, batch_id, settle
    )
    counts = write_wire(captured, stage, batch_id)
    close_job(spark, ledger, batch_id, now)
    drop_directory(spark, work)
    return Captured(batch_id, since, until, counts)


def copy_to_stage(
    lines: DataFrame,
    settle: Settle,
    null_text: str | None = None,
    quarantine: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Typed staging rows of a load, and how many lines per batch were set aside.

    Without a ``quarantine`` path any line that does not fit fails the load. With
    one, an order with such a line is written there with all of its lines and why.
    A line that does not tell whose it is fails the load in both ways, for the
    order that lacks it cannot be held back."""
    if quarantine is None:
        staged = enforced(parse_wire(lines, null_text), OF_STAGING)
        return staged, lines.sparkSession.createDataFrame([], "batch long, aside long")
    judged = settle(judge_wire(lines, null_text), "judged")
    lost = orderless(judged).select("batch", "problem").take(3)
    if lost:
        raise ValueError(f"lines that do not tell their order, e.g. {lost}")
    good, bad = split_wire(judged, null_text)
    bad.write.mode("overwrite").json(quarantine)
    aside = bad.sparkSession.read.schema("batch long").json(quarantine)
    return good, aside.groupBy("batch").agg(F.count(F.lit(1)).alias("aside"))


def _assert_complete(source: DataFrame, aside: DataFrame, expected: DataFrame) -> None:
    """Fail if a batch came with fewer or more lines than it was written with.
    The numbers are summed from the settled source: no pass over the lines."""
    came = source.groupBy(F.col("src_cdt_batch_id").alias("job_exec_id")).agg(F.sum(LINES).alias("came"))
    left = aside.select(F.col("batch").alias("job_exec_id"), "aside")
    found = expected.join(came, "job_exec_id", "full").join(left, "job_exec_id", "full")
    lines = F.coalesce("came", F.lit(0)) + F.coalesce("aside", F.lit(0))
    wrong = found.where(~lines.eqNullSafe(F.col("row_count")))
    some = wrong.select("job_exec_id", "row_count", lines.alias("found")).take(3)
    if some:
        raise ValueError(f"batches whose lines are not all there, e.g. {some}")


def load_lines(
    spark: SparkSession,
    table: OrdersTable,
    lines: DataFrame,
    expected: DataFrame,
    mode: str = "repaired",
    null_text: str | None = None,
    quarantine: str | None = None,
    offered: list[int] | None = None,
) -> int:
    """Load the lines of whole batches and return the new version of the table.
    ``expected`` has the number of lines of each batch (job_exec_id, row_count).
    Whatever is wrong with a line or a batch stops the load before it publishes."""
    table.drop_expired(spark)
    version = table.version(spark) + 1
    work = f"{table.root}/staging/v={version}"
    settle = settle_into(work, PACKING)
    aside = f"{quarantine}/v={version}" if quarantine else None
    staged, set_aside = copy_to_stage(lines, settle, null_text, aside)
    source = settle(stage_preagg(staged, with_lines=True), "source")
    _assert_complete(source, set_aside, expected)
    source = source.drop(LINES)

    buckets = table.buckets(source)
    target = table.read(spark, version - 1, buckets)
    if mode == "repaired":
        assert_one_row_per_line(source)
        first = not table.holders(spark, version - 1).keys() & set(buckets)
        merged = merge_orders(target, source, settle_first(settle) if first else settle)
    else:
        assert_mergeable(target, source)
        merged = merge_orders_reference(target, source)
    batches = [r.job_exec_id for r in expected.select("job_exec_id").collect()]
    table.publish(merged, version, buckets, batches, offered)
    drop_directory(spark, work)
    return version


def load_batches(
    spark: SparkSession,
    stage: Stage,
    table: OrdersTable,
    batch_ids: list[int] | None = None,
    mode: str = "repaired",
    null_text: str | None = None,
    on_error: str = "fail",
    purge: bool = True,
) -> int | None:
    """Load whole capture batches, all that are ready by default, and return the
    new version of the table. Batches it already holds are passed over: a load
    that is run again after a failure changes nothing twice. One number per batch
    that waits comes to the driver, for its folder."""
    configure(spark)
    ready = ready_batches(spark, stage)
    if batch_ids is not None:
        missing = set(batch_ids) - {r.job_exec_id for r in ready.collect()}
        held = {r.job_exec_id for r in table.loaded_batches(spark).collect()}
        if missing - held:
            raise ValueError(f"batches that are not ready: {sorted(missing - held)}")
        ready = ready.where(F.col("job_exec_id").isin(list(batch_ids)))
    loaded = table.loaded_batches(spark)
    done = ready.join(loaded, "job_exec_id", "left_semi")
    waiting = ready.join(loaded, "job_exec_id", "left_anti").collect()
    if purge:
        purge_batches(spark, stage, [r.job_exec_id for r in done.collect()])
    if not waiting:
        return None
    pending = sorted(r.job_exec_id for r in waiting)
    quarantine = on_error == "quarantine"
    version = load_lines(
        spark,
        table,
        read_lines(spark, stage, pending, strict=not quarantine),
        spark.createDataFrame(waiting, ready.schema),
        mode,
        null_text,
        stage.quarantine_path if quarantine else None,
        [r.job_exec_id for r in ready_batches(spark, stage).collect()],
    )
    if purge:
        purge_batches(spark, stage, pending)
    return version


def run_load(spark: SparkSession, stage: Stage, table: OrdersTable, **options) -> int | None:
    """Load every batch that is ready."""
    return load_batches(spark, stage, table, **options)


def write_summary(orders: DataFrame, path: str) -> None:
    """The summary as a table of its own, replaced as a whole."""
    enforced(order_summary(orders), OF_SUMMARY).write.mode("overwrite").parquet(path)
