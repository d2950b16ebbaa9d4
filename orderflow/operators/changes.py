"""Change log: (salesorderid, version, op), op being I, U or D."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RETENTION_DAYS = 3  # fixed value: how long the source keeps its changes


def net_changes(log: DataFrame, since: int, until: int | None = None) -> DataFrame:
    """One row per key changed in ``(since, until]``: D if the last change is a
    delete, else I if the key was inserted in the range, else U.

    The aggregate keeps three numbers per key, so it stays a hash aggregate and
    a key with a third of the log shrinks to one row per task before the shuffle.
    """
    in_range = log.where(F.col("version") > since)
    if until is not None:
        in_range = in_range.where(F.col("version") <= until)
    per_key = in_range.groupBy("salesorderid").agg(
        F.max("version").alias("last"),
        F.max(F.when(F.col("op") == "D", F.col("version"))).alias("last_delete"),
        F.max(F.when(F.col("op") == "I", F.col("version"))).alias("last_insert"),
    )
    return per_key.select(
        "salesorderid",
        F.when(F.col("last_delete") == F.col("last"), "D")
        .when(F.col("last_insert").isNotNull(), "I")
        .otherwise("U")
        .alias("sys_change_op"),
    )


def net_changes_of_keys(feed: DataFrame, since: int) -> DataFrame:
    """The same from a feed that keeps one row per key: salesorderid, op (the
    last), version (of that) and creation_version (of the insert, NULL if none).
    A key created after ``since`` is an insert, whatever happened to it then."""
    created = F.col("creation_version") > since
    return feed.where(F.col("version") > since).select(
        "salesorderid",
        F.when(F.col("op") == "D", "D").when(created, "I").otherwise("U").alias("sys_change_op"),
    )


def keys_of_log(log: DataFrame) -> DataFrame:
    """The feed that keeps one row per key, folded from a log."""
    last = F.max(F.struct("version", "op"))
    created = F.max(F.when(F.col("op") == "I", F.col("version")))
    return (
        log.groupBy("salesorderid")
        .agg(last.alias("last"), created.alias("creation_version"))
        .select("salesorderid", "last.op", "last.version", "creation_version")
    )


def current_version(log: DataFrame) -> DataFrame:
    """One row, 0 for an empty log."""
    return log.agg(F.coalesce(F.max("version"), F.lit(0)).cast("bigint").alias("version"))


def retained_changes(log: DataFrame, now: datetime, days: int = RETENTION_DAYS) -> DataFrame:
    """Changes not yet cleaned up at ``now``; the log has a ``changed_at``."""
    return log.where(F.col("changed_at") >= F.lit(now - timedelta(days=days)).cast("timestamp_ntz"))


def min_valid_version(log: DataFrame, now: datetime, days: int = RETENTION_DAYS) -> DataFrame:
    """One row: the highest version already cleaned up, 0 if none is."""
    expired = log.where(F.col("changed_at") < F.lit(now - timedelta(days=days)).cast("timestamp_ntz"))
    return current_version(expired)


def assert_version_valid(since: int, oldest: int) -> None:
    """A range that starts before the oldest kept version has lost changes."""
    if since < oldest:
        raise ValueError(f"changes since version {since} are gone: kept from {oldest} on")
