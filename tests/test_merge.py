from __future__ import annotations

import pytest

from orderflow.operators import merge, staging
from orderflow.plans.sample_tables import FIRST, SECOND, SampleTables
from orderflow.schemas import ORDERS
from orderflow.session import PACKING, settle_into
from orderflow.sources.orders_table import no_orders
from tests.conftest import SF_SMALL
from tests.rows import TIME, bag, by_key, order_row, orders, source, source_row

KEY = ("salesorderid", "productid")


def state(df):
    """(order, product) -> (quantity, batch, flag)."""
    return {
        k: (r["productorderqty"], r["src_cdt_batch_id"], r["deleted_flg"])
        for k, r in by_key(df, *KEY).items()
    }


# -- staging ------------------------------------------------------------------


def test_repeated_lines_and_null_keys_fold(spark):
    rows = source(
        spark,
        source_row(1, 5, qty=2, sales=0.1), source_row(1, 5, qty=3, sales=0.2),
        source_row(2, None, op="D"), source_row(2, None, op="D"),
    )
    found = by_key(staging.stage_preagg(rows), *KEY)
    assert (found[1, 5]["productorderqty"], found[1, 5]["productsales"]) == (5, 0.3)
    assert found[2, None]["productorderqty"] is None


def test_latest_batch_is_taken_per_order_not_per_line(spark):
    rows = source(
        spark,
        source_row(1, 5, batch=1), source_row(1, 6, batch=1), source_row(1, 5, batch=2, op="U"),
        source_row(2, 5, batch=1), source_row(2, None, batch=2, op="D"),
        source_row(3, 5, batch=1), source_row(4, 5, batch=None),
    )
    kept = by_key(staging.latest_batch_per_order(rows), *KEY, "src_cdt_batch_id")
    assert set(kept) == {(1, 5, 2), (2, None, 2), (3, 5, 1), (4, 5, None)}


# -- reference mode -----------------------------------------------------------


def test_reference_updates_deletes_and_revives(spark):
    target = orders(
        spark, order_row(1, 5), order_row(2, 5), order_row(3, 5, flag=1), order_row(4, 5)
    )
    batch = source(
        spark,
        source_row(1, 5, 2, "U", qty=9),
        source_row(2, 5, 2, "D", qty=9, orderupdatedtm=None),
        source_row(3, 5, 2, "U", qty=9),
        source_row(5, 5, 2, "I", qty=9),
    )
    merged = merge.merge_orders_reference(target, batch)
    assert state(merged) == {
        (1, 5): (9, 2, 0), (2, 5): (1, 2, 1), (3, 5): (9, 2, 0), (4, 5): (1, 1, 0), (5, 5): (9, 2, 0),
    }
    assert by_key(merged, *KEY)[2, 5]["orderupdatedtm"] is None  # set in any case


def test_reference_inserts_what_has_no_product(spark):
    """A delete without lines comes in as a live row; a line-less order again
    on each change."""
    target = orders(spark, order_row(1, 5), order_row(2, None))
    batch = source(spark, source_row(1, None, 2, "D"), source_row(2, None, 2, "U"))
    merged = merge.merge_orders_reference(target, batch)
    rows = sorted((r["salesorderid"], r["src_cdt_batch_id"], r["deleted_flg"]) for r in merged.collect())
    assert rows == [(1, 1, 0), (1, 2, 0), (2, 1, 0), (2, 2, 0)]


def test_reference_null_operation_keeps_values_and_is_live(spark):
    target = orders(spark, order_row(1, 5, flag=1))
    merged = merge.merge_orders_reference(target, source(spark, source_row(1, 5, 2, None, qty=9)))
    assert state(merged) == {(1, 5): (1, 2, 0)}


def test_reference_refuses_two_source_rows_for_one_target_row(spark):
    twice = source(spark, source_row(1, 5, 1), source_row(1, 5, 2, "U"))
    merge.assert_mergeable(orders(spark, order_row(2, 5)), twice)
    with pytest.raises(ValueError, match="several source rows"):
        merge.assert_mergeable(orders(spark, order_row(1, 5)), twice)


def test_row_level_merge_reaches_the_catalog(spark):
    """Parquet tables have no row-level MERGE: the plan is resolved, then
    refused for the table's kind and for nothing else."""
    spark.sql("drop table if exists merge_probe")
    orders(spark, order_row(1, 5)).write.mode("overwrite").saveAsTable("merge_probe")
    with pytest.raises(Exception, match="UNSUPPORTED_FEATURE.TABLE_OPERATION"):
        merge.merge_into_table(source(spark, source_row(1, 5)), "merge_probe")
    spark.sql("drop table merge_probe")


# -- repaired mode ------------------------------------------------------------


def test_delete_without_lines_flags_every_line(spark):
    target = orders(spark, order_row(1, 5), order_row(1, 6), order_row(2, 5))
    merged = merge.merge_orders(target, source(spark, source_row(1, None, 2, "D")))
    assert state(merged) == {(1, 5): (1, 2, 1), (1, 6): (1, 2, 1), (2, 5): (1, 1, 0)}
    assert by_key(merged, *KEY)[1, 5]["orderupdatedtm"] == TIME


def test_delete_that_still_has_lines(spark):
    target = orders(spark, order_row(1, 5), order_row(1, 6))
    batch = source(spark, source_row(1, 5, 2, "D", qty=9), source_row(1, 7, 2, "D", qty=9))
    assert state(merge.merge_orders(target, batch)) == {(1, 5): (1, 2, 1), (1, 6): (1, 2, 1)}


def test_delete_of_an_unknown_order_leaves_one_tombstone(spark):
    batch = source(spark, source_row(1, 5, 2, "D"), source_row(1, 6, 2, "D"), source_row(2, None, 2, "D"))
    merged = merge.merge_orders(orders(spark), batch)
    assert state(merged) == {(1, None): (None, 2, 1), (2, None): (None, 2, 1)}
    late = merge.merge_orders(merged, source(spark, source_row(1, 5, 1, "I")))
    assert state(late) == state(merged)


def test_stale_batch_is_ignored_per_order(spark):
    target = orders(spark, order_row(1, 5, batch=3), order_row(1, 6, batch=1), order_row(2, 5, batch=1))
    batch = source(spark, source_row(1, 6, 2, "U", qty=9), source_row(2, 5, 2, "U", qty=9))
    assert state(merge.merge_orders(target, batch)) == {
        (1, 5): (1, 3, 0), (1, 6): (1, 1, 0), (2, 5): (9, 2, 0),
    }


def test_order_without_lines_is_matched(spark):
    target = orders(spark, order_row(1, None))
    merged = merge.merge_orders(target, source(spark, source_row(1, None, 2, "U")))
    assert state(merged) == {(1, None): (None, 2, 0)}


def test_deleted_order_comes_back(spark):
    target = orders(spark, order_row(1, 5, batch=2, flag=1))
    merged = merge.merge_orders(target, source(spark, source_row(1, 5, 3, "I", qty=9)))
    assert state(merged) == {(1, 5): (9, 3, 0)}


def test_line_gone_from_an_update_stands(spark):
    target = orders(spark, order_row(1, 5), order_row(1, 6))
    merged = merge.merge_orders(target, source(spark, source_row(1, 5, 2, "U", qty=9)))
    assert state(merged) == {(1, 5): (9, 2, 0), (1, 6): (1, 1, 0)}


# -- properties on the test tables --------------------------------------------


@pytest.fixture(scope="module")
def batches(spark, tmp_path_factory):
    from orderflow.plans.named_queries import _source
    from orderflow.session import settle_into

    settle = settle_into(str(tmp_path_factory.mktemp("batches")))
    t = SampleTables(spark, SF_SMALL)
    spans = {"first": (FIRST, 1), "second": (SECOND, 2), "whole": ((0, SECOND[1]), 3)}
    found = {name: settle(_source(t, *args), name) for name, args in spans.items()}
    for old, new in (("none", "first"), ("first", "second")):
        before = spark.createDataFrame([], ORDERS) if old == "none" else found["orders_first"]
        found[f"orders_{new}"] = settle(merge.merge_orders(before, found[new]), f"orders_{new}")
    return found


def live(df):
    return bag(df.where("deleted_flg = 0").drop("src_cdt_batch_id"))


def test_same_batch_twice_changes_nothing(batches):
    again = merge.merge_orders(batches["orders_second"], batches["second"])
    assert bag(again) == bag(batches["orders_second"])


def test_order_of_batches_does_not_matter(spark, batches):
    second = merge.merge_orders(spark.createDataFrame([], ORDERS), batches["second"])
    assert live(merge.merge_orders(second, batches["first"])) == live(batches["orders_second"])


def test_both_batches_in_one_load(spark, batches):
    both = staging.latest_batch_per_order(batches["first"].unionByName(batches["second"]))
    merged = merge.merge_orders(spark.createDataFrame([], ORDERS), both)
    assert live(merged) == live(batches["orders_second"])


def test_one_capture_over_the_whole_range(spark, batches):
    merged = merge.merge_orders(spark.createDataFrame([], ORDERS), batches["whole"])
    assert live(merged) == live(batches["orders_second"])


def test_first_merge_moves_no_rows_of_the_source(spark, tmp_path):
    """Into a table without rows nothing is joined; only the verdicts that matter
    are written."""
    steps = []

    def settle(df, name):
        steps.append(name)
        return settle_into(str(tmp_path), PACKING)(df, name)

    rows = [source_row(i, 10, batch=1) for i in range(1, 5)]
    rows += [source_row(5, 10, op="D", batch=2), source_row(6, 10, batch=1), source_row(6, 11, batch=2)]
    whole = settle_into(str(tmp_path))(source(spark, *rows), "source")
    merged = merge.merge_orders(no_orders(spark), whole, merge.settle_first(settle))
    assert steps == ["verdicts"]
    told = spark.read.parquet(str(tmp_path / "verdicts")).collect()
    assert {(r.salesorderid, r.mixed) for r in told} == {(5, False), (6, True)}
    lines = {(r.salesorderid, r.productid, r.deleted_flg) for r in merged.collect()}
    assert lines == {(1, 10, 0), (2, 10, 0), (3, 10, 0), (4, 10, 0), (5, None, 1), (6, 11, 0)}
