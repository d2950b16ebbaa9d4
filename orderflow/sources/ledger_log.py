"""The job ledger at rest: one small JSON file per event, only ever appended."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from orderflow.operators.constraints import OF_LEDGER, enforced
from orderflow.operators.ledger import (
    last_success_version,
    ledger_current,
    ledger_end,
    ledger_start,
)
from orderflow.schemas import LEDGER
from orderflow.sources.paths import exists


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """One row per job."""
    if not exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return ledger_current(spark.read.schema(LEDGER).json(path))


def _append(event: DataFrame, path: str) -> None:
    enforced(event, OF_LEDGER).coalesce(1).write.mode("append").json(path)


def open_job(spark: SparkSession, path: str, version: int, now: datetime) -> int:
    """Append the start of a job and return its number. The event is one row."""
    row = ledger_start(read_ledger(spark, path), version, now).first()
    _append(spark.createDataFrame([row], LEDGER), path)
    return row["job_exec_id"]


def close_job(spark: SparkSession, path: str, job_exec_id: int, now: datetime) -> None:
    _append(ledger_end(read_ledger(spark, path), job_exec_id, now), path)


def high_water_mark(spark: SparkSession, path: str) -> int:
    return last_success_version(read_ledger(spark, path)).first()["db_chg_version_id"]
