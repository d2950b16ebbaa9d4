"""Every named query against its SQL."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from orderflow.plans.named_queries import QUERIES
from orderflow.plans.oracle import oracle_queries
from tests.check_oracle import differences
from tests.conftest import SF_SMALL


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle_queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, small_duck, name):
    assert differences(spark, small_duck, QUERIES[name], oracle_queries()[name], SF_SMALL) == []


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


# Row counts known from the blueprint's own runs, not from this code.
@pytest.mark.parametrize(
    "name, rows",
    [
        ("net_changes_since", 4_500),
        ("capture_orders", 13_699),
        ("stage_preagg", 60_202),
        ("order_summary_first_load", 60_201),
        ("merge_conflicts", 12_216),
        ("merge_orders_reference", 61_753),
        ("merge_orders", 60_202),
        ("live_orders", 54_146),
        ("merge_ignores_stale", 55_646),
        ("merge_both_batches", 55_646),
    ],
)
def test_known_row_counts(spark, name, rows):
    assert QUERIES[name](spark, "/root/testdata/sf0.01").count() == rows
