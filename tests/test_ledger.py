from __future__ import annotations

from datetime import datetime

from orderflow.operators import ledger as ops
from orderflow.sources import ledger_log
from tests.rows import by_key, ledger

T = [datetime(2020, 1, 1, hour) for hour in range(6)]


def version(df):
    rows = ops.last_success_version(df).collect()
    assert len(rows) == 1
    return rows[0][0]


def test_no_success_yet(spark):
    assert version(ledger(spark)) == 0
    assert version(ledger(spark, (1, None, 50, T[0], None))) == 0


def test_latest_end_wins_over_highest_version(spark):
    rows = [(1, 0, 90, T[0], T[2]), (2, 0, 50, T[1], T[3]), (3, None, 99, T[4], None)]
    assert version(ledger(spark, *rows)) == 50


def test_equal_ends_take_the_higher_version(spark):
    assert version(ledger(spark, (1, 0, 90, T[0], T[2]), (2, 0, 95, T[1], T[2]))) == 95


def test_a_success_before_the_seed_does_not_count(spark):
    assert version(ledger(spark, (1, 0, 7, T[0], datetime(1970, 1, 1)))) == 0


def test_events_fold_to_one_row_per_job(spark):
    started = ledger(spark, (4, None, 10, T[0], None))
    events = started.unionByName(ops.ledger_start(started, 20, T[1]))
    events = events.unionByName(ops.ledger_end(events, 5, T[2]))
    folded = by_key(ops.ledger_current(events), "job_exec_id")
    assert tuple(folded[(5,)].values()) == (5, 0, 20, T[1], T[2])
    assert folded[(4,)]["job_exec_status"] is None


def test_ending_an_unknown_job_does_nothing(spark):
    assert ops.ledger_end(ledger(spark, (1, None, 1, T[0], None)), 2, T[1]).count() == 0


def test_at_rest(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert ledger_log.high_water_mark(spark, path) == 0
    first = ledger_log.open_job(spark, path, 10, T[0])
    second = ledger_log.open_job(spark, path, 20, T[1])
    assert (first, second) == (1, 2)
    ledger_log.close_job(spark, path, first, T[2])
    assert ledger_log.high_water_mark(spark, path) == 10
    ledger_log.close_job(spark, path, second, T[3])
    assert ledger_log.high_water_mark(spark, path) == 20
    assert ledger_log.open_job(spark, path, 30, T[4]) == 3
