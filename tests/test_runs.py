"""Capture and load through files, with failures in between."""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orderflow.plans import runs
from orderflow.plans.sample_tables import FIRST, SampleTables
from orderflow.schemas import ORDERS
from orderflow.sources.change_log import ChangeLog
from orderflow.sources.orders_table import OrdersTable
from orderflow.sources.stage import Stage, mark_ready, ready_batches
from orderflow.streaming.load_stream import start_load_stream
from tests.conftest import SF_SMALL
from tests.rows import bag, order_row, orders
from tests.test_wire import GOOD, OLD, SHORT

NOW = datetime(2025, 1, 1)


class Site:
    """One stage, ledger and table in a folder of the test."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.ledger, self.stage = str(root / "ledger"), Stage(str(root / "stage"))
        self.table = OrdersTable(str(root / "orders"), orders_per_bucket=400)
        self.sample = SampleTables(spark, SF_SMALL)

    def capture(self, until):
        return runs.run_capture(
            self.spark, self.sample.sources(until), self.ledger, self.stage, NOW
        )

    def load(self, **options):
        return runs.run_load(self.spark, self.stage, self.table, **options)

    def stream(self, **options):
        query = start_load_stream(
            self.spark, self.stage, self.table, str(self.root / "checkpoint"), **options
        )
        query.awaitTermination()

    def rows(self, **options):
        return bag(self.table.read(self.spark, **options))


@pytest.fixture
def site(spark, tmp_path):
    return Site(spark, tmp_path)


@pytest.fixture(scope="module")
def expected(spark, tmp_path_factory):
    """The table after two captures, each loaded on its own."""
    site = Site(spark, tmp_path_factory.mktemp("expected"))
    for until in (FIRST[1], 99):
        site.capture(until)
        site.load()
    return site.rows()


def test_capture_goes_on_where_the_last_success_ended(site):
    first, second = site.capture(FIRST[1]), site.capture(99)
    assert (first.batch_id, first.since, first.until) == (1, 0, 50)  # inserts end at 50
    assert (second.batch_id, second.since, second.until) == (2, 50, 99)
    assert first.counts["I"] == first.counts["total"]
    assert second.counts["I"] == 0 and second.counts["D"] > 0
    assert not (site.root / "stage" / "work" / "batch=1").exists()
    third = site.capture(99)  # nothing new
    assert (third.since, third.until, third.counts["total"]) == (99, 99, 0)


def test_failed_capture_is_read_again(site, monkeypatch):
    site.capture(FIRST[1])

    def fail(*_):
        raise OSError("stage is away")

    with monkeypatch.context() as broken:
        broken.setattr(runs, "write_wire", fail)
        with pytest.raises(OSError):
            site.capture(99)
    with monkeypatch.context() as broken:  # written, but not closed
        broken.setattr(runs, "close_job", fail)
        with pytest.raises(OSError):
            site.capture(99)
    again = site.capture(99)
    assert (again.batch_id, again.since) == (4, 50)
    assert {r.job_exec_id for r in ready_batches(site.spark, site.stage).collect()} == {1, 3, 4}
    assert not (site.root / "stage" / "work" / "batch=2").exists()
    site.load()
    assert ready_batches(site.spark, site.stage).count() == 0


def test_capture_over_a_cleaned_log_fails(site):
    with pytest.raises(ValueError, match="gone"):
        runs.run_capture(
            site.spark, site.sample.sources(99), site.ledger, site.stage, NOW, oldest_version=10
        )


def test_both_batches_in_one_load_give_the_same_live_rows(site, expected):
    site.capture(FIRST[1])
    site.capture(99)
    assert site.load() == 1
    flag = sorted(ORDERS.names).index("deleted_flg")
    batch = sorted(ORDERS.names).index("src_cdt_batch_id")

    def live(rows):
        kept = [r for r in rows if r[flag] == 0]
        return sorted((r[:batch] + r[batch + 1 :] for r in kept), key=repr)

    assert live(site.rows()) == live(expected)


def test_loaded_batches_are_purged_and_not_loaded_again(site, expected):
    for until in (FIRST[1], 99):
        site.capture(until)
        site.load()
    assert site.rows() == expected
    assert site.load() is None and site.table.version(site.spark) == 2
    assert list((site.root / "stage" / "data").iterdir()) == []
    assert not (site.root / "orders" / "staging" / "v=2").exists()


def test_load_that_fails_before_it_publishes_can_be_run_again(site, expected, monkeypatch):
    site.capture(FIRST[1])
    site.load()
    before = site.rows()
    site.capture(99)
    real = OrdersTable.publish

    def half(self, rows, version, *_):
        rows.limit(10).write.mode("overwrite").parquet(f"{self.root}/data/v={version}/order_bucket=0")
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(OrdersTable, "publish", half)
        with pytest.raises(OSError):
            site.load()
    assert site.rows() == before  # readers see nothing of it
    assert OrdersTable.publish is real
    site.load()
    assert site.rows() == expected


def test_old_versions_stay_readable_until_dropped(site):
    site.capture(FIRST[1])
    site.load()
    first = site.rows()
    site.capture(99)
    site.load()
    second = site.rows()
    assert site.rows(version=1) == first != second
    site.table.drop_superseded(site.spark, 1)
    assert site.rows() == second
    with pytest.raises(ValueError, match="not older"):
        site.table.drop_superseded(site.spark, 2)


def test_a_load_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    table = OrdersTable(str(tmp_path), orders_per_bucket=100)
    rows = orders(spark, order_row(1, 5), order_row(150, 5), order_row(151, 5), order_row(-7, 5))
    buckets = table.buckets(rows)
    table.publish(rows, 1, buckets, [1])
    table.publish(orders(spark, order_row(1, 6)), 2, [0], [2])
    assert buckets == [-1, 0, 1]
    assert table.holders(spark, 2) == {-1: 1, 0: 2, 1: 1}
    assert sorted(r.job_exec_id for r in table.loaded_batches(spark).collect()) == [1, 2]
    found = {(r.salesorderid, r.productid) for r in table.read(spark).collect()}
    assert found == {(1, 6), (150, 5), (151, 5), (-7, 5)}
    assert {r.salesorderid for r in table.read(spark, buckets=[1, 9]).collect()} == {150, 151}


def test_only_buckets_that_came_to_rows_are_committed(spark, tmp_path):
    table = OrdersTable(str(tmp_path), orders_per_bucket=100)
    table.publish(orders(spark, order_row(1, 5)), 1, [0, 3, 8], [1])
    assert table.holders(spark, 1) == {0: 1} and table.read(spark).count() == 1
    with pytest.raises(ValueError, match="other buckets"):
        table.publish(orders(spark, order_row(150, 5)), 2, [0], [2])
    assert table.version(spark) == 1 and table.read(spark).count() == 1


@pytest.mark.parametrize("row", [order_row(None, 5), order_row(1, 5, flag=2)])
def test_a_row_that_breaks_the_schema_is_not_published(spark, tmp_path, row):
    table = OrdersTable(str(tmp_path), orders_per_bucket=100)
    with pytest.raises(Exception, match="may not be written.*productid"):
        table.publish(orders(spark, row), 1, [0], [1])
    assert table.version(spark) == 0


def test_quarantine(site):
    folder = site.root / "stage" / "data" / "batch=7"
    folder.mkdir(parents=True)
    lines = [GOOD, OLD, GOOD | {"salesorderid": "9", "ProductID": "many"}, GOOD | {"salesorderid": "9"}]
    (folder / "part-0.json").write_text("".join(json.dumps(r) + "\n" for r in lines))
    mark_ready(site.spark, site.stage, 7, 4)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        runs.load_batches(site.spark, site.stage, site.table, [7], null_text="None")
    runs.load_batches(
        site.spark, site.stage, site.table, [7], null_text="None", on_error="quarantine"
    )
    assert {r[8] for r in site.rows()} == {43659, 43660}  # the order keys
    aside = site.spark.read.json(f"{site.stage.quarantine_path}/v=1").collect()
    assert sorted(r.ProductID for r in aside) == ["776", "many"]  # the whole order
    assert sorted(r.problem for r in aside) == ["another line of the order", "unreadable productid"]


def put(site, batch, lines, row_count=None, broken=()):
    """Lines of a batch as a capture would leave them, and some that are broken."""
    folder = site.root / "stage" / "data" / f"batch={batch}"
    folder.mkdir(parents=True, exist_ok=True)
    text = [json.dumps(r | {"job_exec_id": str(batch)}) for r in lines] + list(broken)
    (folder / "part-0.json").write_text("".join(t + "\n" for t in text))
    mark_ready(site.spark, site.stage, batch, len(text) if row_count is None else row_count)


BROKEN = {
    "cut off": dict(lines=[GOOD], broken=[json.dumps(GOOD)[:70]]),
    "no order": dict(lines=[GOOD, {k: v for k, v in GOOD.items() if k != "salesorderid"}]),
    "short": dict(lines=[GOOD], row_count=9),
    "too long": dict(lines=[GOOD, GOOD], row_count=1),
    "unknown operation": dict(lines=[GOOD | {"sys_change_op": "X"}]),
    "one line twice": dict(lines=[GOOD, GOOD | {"productname": "other"}]),
}


@pytest.mark.parametrize("name", BROKEN)
@pytest.mark.parametrize("way", ["batch", "stream"])
def test_a_broken_batch_leaves_the_table_as_it_was(site, name, way):
    put(site, 1, [GOOD, GOOD | {"ProductID": "5"}])
    site.load()
    before = site.rows()
    put(site, 2, **BROKEN[name])
    if way == "stream" and name in ("short", "too long"):
        site.stream()  # waits for the rest
    else:
        with pytest.raises(Exception, match="MALFORMED|may not be written|not all there|several source|no JSON"):
            site.load() if way == "batch" else site.stream()
    assert site.rows() == before and site.table.version(site.spark) == 1


def test_quarantine_refuses_lines_that_belong_to_nobody(site):
    put(site, 2, [GOOD], broken=['{"sales'])
    with pytest.raises(ValueError, match="do not tell their order"):
        site.load(on_error="quarantine")
    assert site.table.version(site.spark) == 0


def test_quarantine_counts_what_it_sets_aside(site):
    put(site, 2, [GOOD, SHORT], broken=[json.dumps(GOOD | {"salesorderid": "8"})[:70]])
    assert site.load(on_error="quarantine") == 1
    assert {r[8] for r in site.rows()} == {43659, 43661}
    put(site, 3, [GOOD], row_count=3, broken=[json.dumps(GOOD | {"salesorderid": "8"})[:70]])
    with pytest.raises(ValueError, match="not all there"):
        site.load(on_error="quarantine")


def test_large_quantities_load(site):
    put(site, 1, [GOOD | {"productorderqty": "2000000000"}] * 2)
    site.load()
    assert site.table.read(site.spark).first().productorderqty == 4_000_000_000


def test_a_quantity_beyond_64_bits_is_reported_and_not_loaded(site):
    huge = [GOOD | {"productorderqty": str(2**62)}] * 2
    put(site, 1, huge)
    with pytest.raises(Exception, match="quantity of a line overflows.*776"):
        site.load()
    assert site.table.version(site.spark) == 0


def test_files_and_versions_do_not_pile_up(site):
    """Ten small loads: what lies about after each is the same."""
    seen = []
    for batch in range(1, 11):
        put(site, batch, [GOOD | {"salesorderid": str(1 + batch % 3), "productorderqty": str(batch)}])
        assert site.load() == batch
        folders = ("stage", "orders/commits", "orders/data", "orders/staging")
        files = [p for f in folders for p in (site.root / f).rglob("*") if not p.name.startswith((".", "_"))]
        seen.append(len(files))
    assert len(set(seen[5:])) == 1, seen
    assert site.table.loaded_batches(site.spark).count() == 1


def test_a_change_log_at_rest_guards_its_own_range(site):
    """After a clean-up a capture whose range is gone fails by itself."""
    log = ChangeLog(str(site.root / "log"), versions_per_part=10)
    start = datetime(2024, 1, 1)
    aged = site.sample.change_log().withColumn(
        "changed_at", F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(F.col("version").cast("int"))
    )
    log.append(aged)
    sources = replace(site.sample.sources(FIRST[1]), change_log=log)
    site.sample.sources = lambda until: sources
    first = site.capture(FIRST[1])
    assert (first.since, first.until) == (0, 99) and first.counts["total"] > 0
    assert log.clean(site.spark, start + timedelta(days=60), days=3) == 50
    assert log.parts(site.spark)[0] == 6 and log.min_valid_version(site.spark) == 50
    again = runs.run_capture(site.spark, sources, site.ledger, site.stage, NOW)
    assert again.since == 99 and again.counts["total"] == 0
    with pytest.raises(ValueError, match="gone"):
        runs.run_capture(site.spark, sources, str(site.root / "other"), site.stage, NOW)
    log.clean(site.spark, start + timedelta(days=900))
    assert log.parts(site.spark) == [9] and log.current_version(site.spark) == 99


def test_reference_mode_refuses_two_batches_of_one_order(site):
    site.capture(FIRST[1])
    site.load(mode="reference")
    for until in (70, 79):  # orders 0, 20, ... are updated at 60, others up to 79
        site.capture(until)
    site.load(mode="reference")  # different orders: fine
    row = {k: v for k, v in GOOD.items() if k != "job_exec_id"}
    for batch in (8, 9):
        folder = site.root / "stage" / "data" / f"batch={batch}"
        folder.mkdir(parents=True)
        line = row | {"salesorderid": "1", "ProductID": "5", "job_exec_id": str(batch)}
        (folder / "part-0.json").write_text(json.dumps(line) + "\n")
        mark_ready(site.spark, site.stage, batch, 1)
    runs.load_batches(site.spark, site.stage, site.table, [8], mode="reference", purge=False)
    folder = site.root / "stage" / "data" / "batch=10"
    folder.mkdir()
    line["job_exec_id"] = "10"
    (folder / "part-0.json").write_text(json.dumps(line) + "\n")
    mark_ready(site.spark, site.stage, 10, 1)
    with pytest.raises(ValueError, match="several source rows"):
        runs.load_batches(site.spark, site.stage, site.table, [9, 10], mode="reference")


@pytest.mark.parametrize("files", [1, 1000])
def test_stream_equals_batch_however_files_are_cut(site, expected, conf, files):
    # More files per batch than one.
    conf(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1b",
    )
    site.capture(FIRST[1])
    site.capture(99)
    assert len(list((site.root / "stage" / "data" / "batch=1").glob("*.json"))) > 2
    site.stream(files_per_trigger=files)
    assert site.rows() == expected
    assert site.table.version(site.spark) == 2


def test_stream_goes_on_after_a_restart(site, expected):
    site.capture(FIRST[1])
    site.stream()
    site.capture(99)
    site.stream()
    assert site.rows() == expected
    assert list((site.root / "orders" / "inbox").glob("epoch=*")) == []


def test_stream_and_batch_run_share_what_is_loaded(site, expected):
    site.capture(FIRST[1])
    site.load()
    site.capture(99)
    site.stream(files_per_trigger=1)  # finds only the second
    assert site.rows() == expected and site.table.version(site.spark) == 2


def test_replayed_micro_batch_changes_nothing(site, expected, monkeypatch):
    """The load is published, then the stream dies before it notes that."""
    site.capture(FIRST[1])
    site.stream()
    site.capture(99)
    from orderflow.streaming import load_stream

    real = load_stream.load_inbox

    def load_and_die(*args, **kwargs):
        real(*args, **kwargs)
        raise OSError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(load_stream, "load_inbox", load_and_die)
        with pytest.raises(Exception, match="driver lost"):
            site.stream()
    site.stream()
    assert site.rows() == expected and site.table.version(site.spark) == 2
