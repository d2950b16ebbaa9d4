from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from orderflow.operators import changes
from tests.rows import log


def net(spark, rows, *span):
    return {r[0]: r[1] for r in changes.net_changes(log(spark, *rows), *span).collect()}


def test_last_delete_wins_then_insert_then_update(spark):
    rows = [
        (1, 1, "I"), (1, 2, "U"), (1, 3, "D"),
        (2, 1, "I"), (2, 4, "U"),
        (3, 2, "U"), (3, 3, "U"),
        (4, 1, "D"), (4, 2, "I"),
    ]
    assert net(spark, rows, 0) == {1: "D", 2: "I", 3: "U", 4: "I"}


def test_range_is_open_below_and_closed_above(spark):
    rows = [(1, 5, "I"), (2, 6, "U"), (3, 7, "U"), (3, 8, "D")]
    assert net(spark, rows, 5, 7) == {2: "U", 3: "U"}


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 3), st.sampled_from("IUD")), min_size=1, max_size=12))
def test_net_changes_equal_a_replay(spark, ops):
    rows = [(key, version, op) for version, (key, op) in enumerate(ops, 1)]
    expected = {}
    for key, op in ops:
        inserted = expected.get(key, (None, False))[1] or op == "I"
        expected[key] = ("D" if op == "D" else "I" if inserted else "U", inserted)
    assert net(spark, rows, 0) == {key: op for key, (op, _) in expected.items()}


def test_current_version_of_an_empty_log_is_zero(spark):
    assert changes.current_version(log(spark).where("false")).first()[0] == 0


def test_retention(spark):
    rows = [(1, 1, "I", datetime(2020, 1, 1)), (1, 2, "U", datetime(2020, 1, 2))]
    aged = spark.createDataFrame(
        rows, "salesorderid long, version long, op string, changed_at timestamp_ntz"
    )
    now = datetime(2020, 1, 5)
    assert [r.version for r in changes.retained_changes(aged, now).collect()] == [2]
    assert changes.min_valid_version(aged, now).first()[0] == 1
    assert changes.min_valid_version(aged, datetime(2020, 1, 3)).first()[0] == 0


def test_a_range_that_was_cleaned_up_fails():
    changes.assert_version_valid(5, 5)
    with pytest.raises(ValueError, match="gone"):
        changes.assert_version_valid(4, 5)
