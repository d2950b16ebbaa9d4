"""Job ledger: appended events, one when a job starts and one when it ends."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.schemas import LEDGER

SUCCESS = 0
# What a ledger without a successful run counts as.
FIRST_VERSION = 0
FIRST_END = datetime(1980, 1, 1)


def _at(moment: datetime):
    return F.lit(moment).cast("timestamp_ntz")


def ledger_current(events: DataFrame) -> DataFrame:
    """One row per job. A column is set by at most one of a job's events."""
    return (
        events.groupBy("job_exec_id")
        .agg(*[F.max(name).alias(name) for name in LEDGER.names if name != "job_exec_id"])
        .select(LEDGER.names)
    )


def ledger_start(ledger: DataFrame, version: int, now: datetime) -> DataFrame:
    """The row to append for a new job, numbered after the highest so far."""
    return ledger.agg(
        (F.coalesce(F.max("job_exec_id"), F.lit(0)) + 1).cast("bigint").alias("job_exec_id")
    ).select(
        "job_exec_id",
        F.lit(None).cast("int").alias("job_exec_status"),
        F.lit(version).cast("bigint").alias("db_chg_version_id"),
        _at(now).alias("job_start_ts"),
        F.lit(None).cast("timestamp_ntz").alias("job_end_ts"),
    )


def ledger_end(ledger: DataFrame, job_exec_id: int, now: datetime) -> DataFrame:
    """The row to append when a job has succeeded; none if it never started."""
    return (
        ledger.where(F.col("job_exec_id") == job_exec_id)
        .select("job_exec_id")
        .distinct()
        .select(
            "job_exec_id",
            F.lit(SUCCESS).cast("int").alias("job_exec_status"),
            F.lit(None).cast("bigint").alias("db_chg_version_id"),
            F.lit(None).cast("timestamp_ntz").alias("job_start_ts"),
            _at(now).alias("job_end_ts"),
        )
    )


def last_success_version(ledger: DataFrame) -> DataFrame:
    """One row: the version of the success that ended last, not of the highest
    version; among equal end times the higher version."""
    seed = ledger.sparkSession.range(1).select(
        F.lit(FIRST_VERSION).cast("bigint").alias("db_chg_version_id"),
        _at(FIRST_END).alias("job_end_ts"),
    )
    return (
        ledger.where(F.col("job_exec_status") == SUCCESS)
        .select("db_chg_version_id", "job_end_ts")
        .unionByName(seed)
        .orderBy(F.desc_nulls_last("job_end_ts"), F.desc_nulls_last("db_chg_version_id"))
        .limit(1)
        .select("db_chg_version_id")
    )
