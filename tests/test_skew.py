"""A third of the rows under one key, with joins that may not broadcast."""

from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from orderflow.operators import capture, changes, keys, merge, nested, staging
from orderflow.operators.joins import children_of, fan_out, look_up
from orderflow.schemas import ORDERS
from orderflow.session import settle_into
from orderflow.sources.orders_table import OrdersTable
from tests.rows import bag, order_row, orders

ROWS, HOT = 60_000, 7


@pytest.fixture(autouse=True)
def no_broadcast_and_small_partitions(conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="2KB",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1b",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="2KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )


def skewed(spark, key, other):
    """Every third row under one key, the rest spread; read by many tasks."""
    i = F.col("id")
    return spark.range(0, ROWS, 1, 16).select(
        F.when(i % 3 == 0, HOT).otherwise(i % 5_000).cast("bigint").alias(key),
        i.alias(other),
    )


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()  # this frame's own execution
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_hot_parent_is_split(spark):
    parents = spark.range(6_000).select(F.col("id").alias("k"), (-F.col("id")).alias("p"))
    rows, plan = final_plan(children_of(parents, skewed(spark, "k", "c"), "k"))
    assert "SortMergeJoin(skew=true)" in plan
    assert len(rows) == ROWS and all(r.p == -r.k for r in rows)


def test_hot_lookup_is_split(spark):
    table = spark.range(4_000).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    rows, plan = final_plan(look_up(skewed(spark, "k", "c"), table, "k"))
    assert "SortMergeJoin(skew=true)" in plan
    assert len(rows) == ROWS and all((r.name is None) == (r.k >= 4_000) for r in rows)


def test_fan_out_equals_a_left_outer_join(spark):
    parents = spark.range(6_000).select(F.col("id").alias("k"))
    children = skewed(spark, "k", "c").where("k < 3000")
    got, plan = final_plan(fan_out(parents, children, "k").select("k", "c"))
    assert "SortMergeJoin(skew=true)" in plan
    assert sorted(map(tuple, got), key=repr) == sorted(
        map(tuple, parents.join(children, "k", "left").collect()), key=repr
    )


def test_capture_of_a_hot_order_and_a_hot_product(spark, tmp_path):
    log = spark.range(5_000).selectExpr("id as salesorderid", "1L as version", "'U' as op")
    net = changes.net_changes(log, 0)
    header = spark.range(5_000).selectExpr(
        "id as salesorderid", "id % 9 as shiptoaddressid",
        "timestamp_ntz'2020-01-01' as orderdate", "timestamp_ntz'2020-01-01' as modifieddate",
    )
    detail = skewed(spark, "salesorderid", "n").selectExpr(
        "salesorderid", "if(n % 3 = 1, 1, n % 50) as productid", "1 as orderqty",
        "cast(1 as decimal(18,4)) as linetotal",
    )
    product = spark.range(50).selectExpr("id as productid", "'x' as name")
    address = spark.range(9).selectExpr("id as addressid", "'0' as postalcode")
    settle = settle_into(str(tmp_path))
    rows, plan = final_plan(
        capture.capture_orders(net, header, detail, product, address, 1, settle)
    )
    assert "SortMergeJoin(skew=true)" in plan
    with_lines = [r for r in rows if r.ProductID is not None]
    assert len(with_lines) == ROWS
    assert len({r.salesorderid for r in rows}) == 5_000
    assert all(r.productname == "x" and r.PostalCode == "0" for r in with_lines)


def hot_source(spark, batch):
    """A hot order with a third of all (order, product) keys."""
    return skewed(spark, "salesorderid", "n").selectExpr(
        "salesorderid", "n as productid", "date'2020-01-01' as orderdate", "'x' as productname",
        "'0' as postalcode", f"{batch} as productorderqty", "1.5D as productsales",
        "'U' as sys_change_op", "timestamp_ntz'2020-01-01' as orderupdatedtm",
        f"cast({batch} as bigint) as src_cdt_batch_id",
    )


def test_latest_batch_of_a_hot_order(spark):
    both = hot_source(spark, 1).unionByName(hot_source(spark, 2).where("salesorderid < 100"))
    rows, plan = final_plan(staging.latest_batch_per_order(both))
    assert "SortMergeJoin(skew=true)" in plan and "Window" not in plan
    assert len(rows) == ROWS
    assert all(r.src_cdt_batch_id == (2 if r.salesorderid < 100 else 1) for r in rows)


def test_merge_into_a_hot_order(spark, tmp_path):
    written, plans = settle_into(str(tmp_path)), []

    def settle(df, name):
        plans.append(final_plan(df)[1])
        return written(df, name)

    loaded = hot_source(spark, 1).withColumn("deleted_flg", F.lit(0)).select(ORDERS.names)
    target = written(loaded.repartition(16), "target")
    batch = hot_source(spark, 2).where(f"salesorderid = {HOT} and productid % 2 = 0")
    values = {"salesorderid": 8, "sys_change_op": "D", "src_cdt_batch_id": 2}
    delete = spark.range(1).select(
        [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in batch.schema]
    )
    source = written(batch.repartition(16).unionByName(delete), "source")
    rows, plan = final_plan(merge.merge_orders(target, source, settle))
    plans.append(plan)
    split = ["SortMergeJoin(skew=true)" in p for p in plans]
    # incoming, standing, verdicts, changes; then by (order, product), where nothing is hot
    assert split == [False, True, False, True, False]
    for word in ("Window", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert not any(word in p for p in plans)
    assert len(rows) == ROWS
    for r in rows:
        if r.salesorderid == HOT:
            assert r.productorderqty == (2 if r.productid % 2 == 0 else 1)
        assert r.deleted_flg == (r.salesorderid == 8)


def test_preagg_of_a_hot_order_shuffles_by_all_keys(spark):
    """Behind a join by order, the sum may not stay in the order's partition."""
    parents = spark.range(6_000).select(F.col("id").alias("salesorderid"))
    joined = children_of(parents, hot_source(spark, 1), "salesorderid")
    rows, plan = final_plan(staging.stage_preagg(joined))
    assert len(rows) == ROWS
    assert "SortMergeJoin(skew=true)" in plan
    aggregate = plan[plan.index("HashAggregate") :]
    exchange = aggregate[aggregate.index("Exchange hashpartitioning(") :].split("\n")[0]
    assert "productid" in exchange and "salesorderid" in exchange


def test_keys_for_rows_that_all_sort_alike(spark):
    rows = spark.range(0, ROWS, 1, 16).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("name")
    )
    keyed = keys.assign_keys(rows, ["name"], "key", 100)
    got = sorted((r.key, r.name) for r in keyed.collect())
    assert [k for k, _ in got] == list(range(101, 101 + ROWS))
    assert [n for _, n in got] == sorted(n for _, n in got)
    sizes = keyed.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < ROWS / 3  # the hot name does not fill one partition


def test_documents_of_a_hot_order_are_bounded(spark, tmp_path):
    documents = nested.nest_details(skewed(spark, "salesorderid", "productid"), 100)
    assert documents.agg(F.max(F.size("orderdetails"))).first()[0] <= 100
    lines = nested.split_orders(documents, str(tmp_path / "split"))[1]
    assert bag(lines) == bag(skewed(spark, "salesorderid", "productid"))


def test_a_hot_bucket_is_written_by_many_tasks(spark, tmp_path):
    table = OrdersTable(str(tmp_path), orders_per_bucket=1_000)
    source = hot_source(spark, 1)
    table.publish(merge.merge_orders(orders(spark), source), 1, table.buckets(source), [1])
    files = defaultdict(int)
    for part in (tmp_path / "data").rglob("*.parquet"):
        files[part.parent.name] += 1
    assert files["order_bucket=0"] > 1
    assert table.read(spark).count() == ROWS


def test_orders_without_a_product_spread(spark):
    """NULL products never meet in one partition: the key has the order, too."""
    rows = [order_row(i, None) for i in range(200)]
    joined = orders(spark, *rows).repartition(8, "salesorderid", "productid")
    assert joined.select(F.spark_partition_id()).distinct().count() == 8
