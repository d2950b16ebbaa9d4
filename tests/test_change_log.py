"""The change log at rest: what its plans read, and what its retention leaves."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orderflow.operators import changes, ledger
from orderflow.sources import change_log
from orderflow.sources.change_log import ChangeLog
from tests.rows import bag, log
from tests.rows import ledger as jobs

START = datetime(2024, 1, 1)


@pytest.fixture
def at_rest(spark, tmp_path):
    """One change per version, 0 to 99, one a day; ten versions a part."""
    rows = spark.range(100).select(
        (F.col("id") % 7).alias("salesorderid"),
        F.col("id").alias("version"),
        F.when(F.col("id") < 7, "I").otherwise("U").alias("op"),
        (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int"))).alias("changed_at"),
    )
    at_rest = ChangeLog(str(tmp_path / "log"), versions_per_part=10)
    at_rest.append(rows)
    return at_rest


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def versions(df):
    return sorted(r.version for r in df.select("version").collect())


def files_read(df):
    """Folders of the log that a run of the frame has read."""
    names = df.select(F.regexp_extract("_metadata.file_path", r"version_part=(\\d+)", 1).alias("p"))
    return {int(r.p) for r in names.distinct().collect()}


def test_ranges_read_their_partitions(spark, at_rest):
    found = at_rest.between(spark, 39, 52)
    assert versions(found) == list(range(40, 53))
    text = plan(found)
    assert re.search(r"PartitionFilters: \[[^\]]*>= 4[^\]]*<= 5", text)
    assert "GreaterThan(version,39)" in text
    assert versions(at_rest.between(spark, 94)) == list(range(95, 100))
    assert versions(at_rest.between(spark, 99)) == []


def test_a_mark_prunes_the_log_when_the_query_runs(spark, at_rest):
    events = jobs(spark, (1, 0, 75, START, START), (2, None, 90, START, None))
    found = at_rest.after(ledger.last_success_version(events))
    assert "dynamicpruning" in plan(found)
    assert versions(found) == list(range(76, 100))
    scanned = spark.read.schema(at_rest.read(spark).schema).parquet(f"{at_rest.root}/data").inputFiles()
    assert len({re.search(r"version_part=\d+", f).group() for f in scanned}) == 10
    last = jobs(spark, (1, 0, 99, START, START))
    assert versions(at_rest.after(ledger.last_success_version(last))) == []


def test_the_newest_version_comes_from_footers(spark, at_rest):
    newest = at_rest.newest_version(spark)
    text = plan(newest)
    assert "PushedAggregation: [MAX(version)]" in text and "version_part=9" in text
    assert "version_part=8" not in text
    assert newest.first().version == 99
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""  # the caller's stays


def test_retention_drops_whole_partitions_and_says_so(spark, at_rest):
    assert at_rest.clean(spark, START + timedelta(days=20)) == 9  # part 1 has days 10 to 19
    assert at_rest.parts(spark) == list(range(1, 10))
    assert at_rest.clean(spark, START + timedelta(days=20)) == 9
    assert at_rest.clean(spark, START + timedelta(days=10_000)) == 89
    assert at_rest.parts(spark) == [9] and at_rest.current_version(spark) == 99
    assert versions(at_rest.read(spark)) == list(range(90, 100))


def test_retention_does_not_read_what_is_kept(spark, at_rest):
    """Parts behind the first kept ones are not opened; here one cannot be."""
    with open(f"{at_rest.root}/data/version_part=8/part-broken.parquet", "w") as file:
        file.write("no Parquet")
    assert at_rest.clean(spark, START + timedelta(days=20)) == 9
    assert at_rest.parts(spark) == list(range(1, 10))


def test_many_narrow_parts_share_folders_and_expire_by_part(spark, tmp_path, monkeypatch):
    """30 parts of one change, one a day, of which at most eight folders are made."""
    monkeypatch.setattr(change_log, "FOLDERS_AT_ONCE", 8, raising=False)
    rows = spark.range(30).select(
        (F.col("id") % 7).alias("salesorderid"),
        F.col("id").alias("version"),
        F.lit("U").alias("op"),
        (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int"))).alias("changed_at"),
    )
    narrow = ChangeLog(str(tmp_path / "narrow"), versions_per_part=1)
    narrow.append(rows)
    assert narrow.parts(spark) == list(range(0, 30, 4))
    assert narrow.current_version(spark) == 29
    assert versions(narrow.between(spark, 10, 17)) == list(range(11, 18))
    mark = ledger.last_success_version(jobs(spark, (1, 0, 21, START, START)))
    assert versions(narrow.after(mark)) == list(range(22, 30))
    # The first that is kept is 13; the folder it shares with 12 stays.
    assert narrow.clean(spark, START + timedelta(days=16)) == 12
    assert narrow.parts(spark) == list(range(12, 30, 4))
    assert versions(narrow.read(spark)) == list(range(13, 30))
    # Later changes have folders of their own, beside one that reaches as far.
    narrow.append(log(spark, (1, 29, "U"), (1, 31, "D")))
    assert narrow.current_version(spark) == 31
    assert versions(narrow.between(spark, 27)) == [28, 29, 29, 31]
    assert narrow.clean(spark, START + timedelta(days=900)) == 29  # never the newest
    assert narrow.parts(spark) == [31] and versions(narrow.read(spark)) == [31]


def test_an_empty_log(spark, tmp_path):
    empty = ChangeLog(str(tmp_path / "none"))
    assert empty.current_version(spark) == 0 and empty.min_valid_version(spark) == 0
    assert empty.read(spark).count() == 0 and empty.between(spark, 5).count() == 0
    assert empty.after(ledger.last_success_version(jobs(spark))).count() == 0


def test_later_changes_are_added(spark, at_rest):
    at_rest.append(log(spark, (1, 100, "D"), (2, 2_000, "U")))
    assert at_rest.current_version(spark) == 2_000
    assert versions(at_rest.between(spark, 98, 500)) == [99, 100]


def test_keys_tell_the_same_changes_as_the_log(spark):
    rows = [
        (1, 1, "I"), (1, 2, "U"), (1, 3, "D"), (2, 1, "I"), (2, 4, "U"),
        (3, 4, "I"), (3, 5, "U"), (4, 1, "D"), (4, 6, "I"), (5, 2, "U"),
    ]
    events = log(spark, *rows)
    for since in range(7):
        told = changes.net_changes_of_keys(changes.keys_of_log(events), since)
        assert bag(told) == bag(changes.net_changes(events, since))
