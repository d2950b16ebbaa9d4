"""What the plans must and must not hold."""

from __future__ import annotations

import re
import uuid

import pytest
from pyspark.sql import functions as F

from orderflow.operators import capture, changes, merge, nested, summary
from orderflow.operators.joins import look_up
from orderflow.plans.named_queries import QUERIES
from orderflow.plans.oracle import oracle_queries
from orderflow.plans.sample_tables import SECOND, SampleTables
from orderflow.schemas import ORDERS
from orderflow.session import settle_into
from orderflow.sources.tables import SourceTables
from tests.conftest import SF_SMALL
from tests.rows import order_row, orders, source, source_row


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("orders") / "t")
    orders(spark, order_row(1, 5), order_row(2, 5)).write.parquet(path)
    return spark.read.schema(ORDERS).parquet(path)


def test_summary_pushes_the_flag_and_reads_what_it_needs(table):
    text = plan(summary.order_summary(table))
    assert "EqualTo(deleted_flg,0)" in text
    assert "src_cdt_batch_id" not in text and "salesorderid" not in text
    assert text.count("Exchange") == 1 and "partial_sum" in text


def test_version_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "log")
    SampleTables(spark, SF_SMALL).change_log().write.parquet(path)
    text = plan(changes.net_changes(spark.read.parquet(path), 59, 95))
    assert "GreaterThan(version,59)" in text and "LessThanOrEqual(version,95)" in text
    assert text.count("Exchange") == 1 and "SortAggregate" not in text


def test_changed_key_range_reaches_the_scan(spark, tmp_path):
    header = str(tmp_path / "header")
    SampleTables(spark, SF_SMALL).header(99).write.parquet(header)
    frame = spark.read.parquet(header)
    net = spark.range(40, 60).withColumnRenamed("id", "salesorderid")
    text = plan(SourceTables(frame, frame, frame, frame, frame).of_changes(net).detail)
    assert "GreaterThanOrEqual(salesorderid,40)" in text
    assert "LessThanOrEqual(salesorderid,59)" in text


def test_many_changed_orders_are_not_broadcast_however_small_their_file(spark, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="10MB")
    frame = spark.range(1_000_000).withColumnRenamed("id", "salesorderid")
    for orders, broadcast in ((300, True), (300_000, False)):
        net = settle_into(str(tmp_path))(frame.limit(orders).withColumn("sys_change_op", F.lit("I")), f"net{orders}")
        tables = SourceTables(frame, frame, frame, frame, frame).of_changes(net)
        for table in (tables.header, tables.detail):
            assert ("BroadcastHashJoin" in plan(table)) == broadcast
            assert table.count() == orders


def test_no_changes_no_rows(spark):
    frame = spark.range(5).withColumnRenamed("id", "salesorderid")
    tables = SourceTables(frame, frame, frame, frame, frame).of_changes(frame.where("false"))
    assert tables.header.count() == 0


def test_small_batch_shuffles_nothing_of_a_large_target(spark, tmp_path, conf):
    """Joins of the target broadcast the batch; what is shuffled is matches."""
    conf(spark__sql__autoBroadcastJoinThreshold="20KB")
    written = settle_into(str(tmp_path))
    n = spark.range(50_000).selectExpr("id as n")
    large = written(
        n.select(
            [
                {"salesorderid": F.col("n"), "productid": F.hash("n")}
                .get(f.name, F.lit(1 if f.name == "src_cdt_batch_id" else None))
                .cast(f.dataType)
                .alias(f.name)
                for f in ORDERS
            ]
        ),
        "target",
    )
    batch = written(source(spark, source_row(1, 5, 2, "U"), source_row(2, None, 2, "D")), "batch")
    steps = []

    def settle(df, name):
        steps.append(plan(df))
        return written(df, name)

    for merged in (
        merge.merge_orders_reference(large, batch),
        merge.merge_orders(large, batch, settle),
    ):
        text = plan(merged)
        kept = text[: text.index("LeftOuter") + 9]
        assert "BroadcastHashJoin" in kept and "SortMergeJoin" not in kept
        steps.append(text)
    assert "BroadcastHashJoin [salesorderid" in steps[1] and "LeftSemi" in steps[1]
    semi = re.search(r"(\w+) \[salesorderid[^\n]*LeftSemi", steps[-2])
    assert semi.group(1) == "BroadcastHashJoin"


def test_many_incoming_orders_are_not_broadcast_however_small_their_file(spark, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="10MB")
    written, steps = settle_into(str(tmp_path)), {}
    row = source(spark, source_row(1, 5, 2, "D")).drop("salesorderid")
    batch = row.crossJoin(spark.range(300_000).withColumnRenamed("id", "salesorderid"))
    batch = written(batch.select(source(spark).columns), "batch")
    lines = written(batch.drop("sys_change_op").withColumns({"src_cdt_batch_id": F.lit(1).cast("long"), "deleted_flg": F.lit(0)}), "target")

    def settle(df, name):
        steps[name] = plan(df)
        return written(df, name)

    merged = merge.merge_orders(lines.select(ORDERS.names), batch, settle)
    for name, kind in (("standing", "LeftSemi"), ("changes", "Inner")):
        assert re.search(rf"(\w+) \[salesorderid[^\n]*{kind}", steps[name]).group(1) == "SortMergeJoin", name
    assert merged.where("deleted_flg = 1 and src_cdt_batch_id = 2").count() == merged.count() == 300_000


@pytest.mark.parametrize("limit", ["-1", "10MB"])
def test_capture_has_one_plan_at_any_size(spark, small_duck, tmp_path, conf, limit):
    """The same steps whatever may be broadcast; addresses are looked up for
    changed orders only."""
    conf(spark__sql__autoBroadcastJoinThreshold=limit)
    sample, written, steps = SampleTables(spark, SF_SMALL), settle_into(str(tmp_path)), {}

    def settle(df, name):
        steps[name] = written(df, name)
        return steps[name]

    net = settle(changes.net_changes(sample.change_log(), *SECOND), "net")
    rows = capture.capture_orders(
        net, sample.header(99), sample.detail(99), sample.product(), sample.address(), 2, settle
    )
    assert list(steps) == ["net", "changed_headers", "changed_orders", "changed_lines"]
    assert steps["changed_headers"].count() == steps["changed_orders"].count() == net.count()
    sql = oracle_queries()["capture_orders"]
    assert rows.count() == small_duck.execute(f"select count(*) from ({sql})").fetchone()[0]


def test_a_large_table_is_cut_down_by_a_bloom_filter(spark, tmp_path, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="0",
    )
    written = settle_into(str(tmp_path))
    rows = written(spark.range(1_000).selectExpr("id", "if(id % 9 = 0, null, 40 + id % 50) as k"), "rows")
    table = written(spark.range(100_000).selectExpr("id as k", "2 * id as v"), "table")
    found = look_up(rows, table, "k")
    text = plan(found)
    assert "might_contain" in text and "GreaterThanOrEqual(k,40)" in text
    assert {(r.k, r.v) for r in found.collect()} == {(None, None)} | {(k, 2 * k) for k in range(40, 90)}
    assert found.count() == 1_000


def test_nested_orders_are_read_once_to_be_split(spark, tmp_path):
    documents = SampleTables(spark, SF_SMALL).nested_orders()
    path = str(tmp_path / "documents")
    documents.write.parquet(path)
    seen = []
    read = spark.read.parquet(path)
    headers, lines = nested.split_orders(read, str(tmp_path / "split"))
    assert (headers.count(), lines.count()) == (1_500, spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count())
    for frame in (headers, lines):
        seen += frame.inputFiles()
    assert all("/kind=" in f and "/documents/" not in f for f in seen)


def test_row_level_merges_resolve(spark, tmp_path):
    """No catalog here can run a MERGE: both are understood, and refused for the
    table's sake alone."""
    name = f"orders_{uuid.uuid4().hex}"
    orders(spark, order_row(1, 5)).write.option("path", str(tmp_path / "t")).saveAsTable(name)
    batch = source(spark, source_row(1, 5, 2, "U"), source_row(2, None, 2, "D"))
    actions = merge.merge_source(spark.table(name), batch)
    for ready in (merge.reference_merge(batch, name), merge.repaired_merge(actions, name)):
        with pytest.raises(Exception, match="does not support MERGE INTO"):
            ready.merge()
    odd = actions.withColumnRenamed("orderdate", "day").withColumn("orderdate", F.lit("x").cast("binary"))
    with pytest.raises(Exception, match="INCOMPATIBLE|CAST|cast"):
        merge.repaired_merge(odd, name).merge()
    spark.sql(f"drop table {name}")


EAGER = re.compile("load_run|load_stream")


@pytest.mark.parametrize("name", [n for n in QUERIES if not EAGER.match(n)])
def test_no_python_no_cross_join_no_global_window(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Window "):
        assert word not in text, word


def test_hour_of_zoneless_times_ignores_the_session_zone(spark, conf):
    conf(spark__sql__session__timeZone="Asia/Tokyo")
    assert summary.order_summary(orders(spark, order_row(1, 5))).first().orderhour == 5


def test_live_orders_drops_null_flags(spark):
    rows = orders(spark, order_row(1, 5), order_row(2, 5, flag=1), order_row(3, 5, flag=None))
    assert [r.salesorderid for r in summary.live_orders(rows).collect()] == [1]


def test_sums_do_not_depend_on_the_order_of_rows(spark):
    rows = [order_row(i, 5, productsales=0.1) for i in range(1_000)]
    for parts in (1, 7):
        total = summary.order_summary(orders(spark, *rows).repartition(parts)).first()
        assert total.productsales == 100.0
        assert total.productsalesvolume == 1_000


def test_both_batches_are_computed_once_for_the_latest(spark):
    """The rows are read twice: from the settled step, not from the tables again."""
    read = QUERIES["latest_batch_per_order"](spark, SF_SMALL).inputFiles()
    assert read and all("/both/" in f for f in read)
