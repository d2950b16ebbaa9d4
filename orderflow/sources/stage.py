"""The stage: a folder of JSON lines per capture batch, and beside it a small file
with the number of its lines.

    <root>/data/batch=<id>/part-*.json
    <root>/ready/batch=<id>/part-*.json

A reader takes a batch only if it has found as many lines as ``ready`` names. So
the lines of one order may lie in any number of files, an order with a third of
all lines is written by many tasks, and a lost or half-written file is noticed.
Both folders of a batch go when it is loaded: the stage holds what waits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.operators.capture import OPERATIONS, count_by_op
from orderflow.operators.wire import CORRUPT, stringify_wire
from orderflow.schemas import READY, WIRE
from orderflow.sources.paths import drop_directory, subdirectories


@dataclass(frozen=True)
class Stage:
    """``compression`` is that of the lines (none, gzip, ...), for who writes them;
    a reader goes by the names of the files."""

    root: str
    compression: str | None = None

    @property
    def ready_path(self) -> str:
        return f"{self.root}/ready"

    @property
    def quarantine_path(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def files(self) -> str:
        """Lines and numbers of lines, as one pattern."""
        return f"{self.root}/{{data,ready}}/batch=*"

    def batch_path(self, batch_id: int) -> str:
        return f"{self.root}/data/batch={batch_id}"

    def ready_file(self, batch_id: int) -> str:
        return f"{self.ready_path}/batch={batch_id}"


def write_wire(captured: DataFrame, stage: Stage, batch_id: int) -> dict[str, int]:
    """Write a capture batch, then the number of its lines. NULL fields are left
    out. Few changes in a large table come from many scan tasks; rebalancing makes
    files of even size of them. It moves the rows before they become text, and by
    order, so that lines that are alike lie together; a hot order is split again.
    Returns the rows per operation and in total, counted on what was written: a
    figure taken along the way would be too high where a lost executor makes tasks
    run twice."""
    spark = captured.sparkSession
    even = captured.hint("rebalance", F.col("salesorderid"))
    stringify_wire(even).write.mode("overwrite").json(
        stage.batch_path(batch_id), compression=stage.compression
    )
    found = {r.sys_change_op: r.row_count for r in count_by_op(read_wire(spark, stage, [batch_id])).collect()}
    total = sum(found.values())
    mark_ready(spark, stage, batch_id, total)
    return {"total": total, **dict.fromkeys(OPERATIONS, 0), **found}


def mark_ready(spark: SparkSession, stage: Stage, batch_id: int, row_count: int) -> None:
    spark.range(1).select(
        F.lit(batch_id).cast("bigint").alias("job_exec_id"),
        F.lit(row_count).cast("bigint").alias("row_count"),
    ).coalesce(1).write.mode("overwrite").json(stage.ready_file(batch_id))


def read_wire(spark: SparkSession, stage: Stage, batch_ids: list[int]) -> DataFrame:
    """The wire rows of whole batches; all fields are read as text. A line that is
    no JSON fails the read."""
    paths = [stage.batch_path(b) for b in batch_ids]
    return spark.read.schema(WIRE).option("mode", "FAILFAST").json(paths)


def batch_of_file() -> Column:
    """The batch a line was read from, by the name of its folder."""
    return F.regexp_extract("_metadata.file_path", r"batch=(\d+)", 1).try_cast("bigint")


def read_lines(
    spark: SparkSession, stage: Stage, batch_ids: list[int], strict: bool = True
) -> DataFrame:
    """The wire rows with their ``batch``. Strict, a line that is no JSON fails the
    read; else its text is kept in a column of its own."""
    paths = [stage.batch_path(b) for b in batch_ids]
    schema = WIRE if strict else T.StructType([*WIRE, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    lines = reader.json(paths)
    return lines.select(*schema.names, batch_of_file().alias("batch"))


def ready_batches(spark: SparkSession, stage: Stage) -> DataFrame:
    if not subdirectories(spark, stage.ready_path, "batch="):
        return spark.createDataFrame([], READY)
    return spark.read.schema(READY).json(f"{stage.ready_path}/batch=*")


def lines_in_stage(spark: SparkSession, stage: Stage, batch_ids: list[int]) -> DataFrame:
    """Lines per batch, whatever is in them."""
    text = spark.read.text([stage.batch_path(b) for b in batch_ids])
    return text.groupBy(batch_of_file().alias("job_exec_id")).agg(
        F.count(F.lit(1)).alias("line_count")
    )


def short_batches(spark: SparkSession, stage: Stage) -> DataFrame:
    """Ready batches whose lines are not all there, or too many."""
    ready = ready_batches(spark, stage)
    held = {int(name[6:]) for name in subdirectories(spark, f"{stage.root}/data", "batch=")}
    if not held:
        return ready.where("row_count > 0").withColumn("line_count", F.lit(0).cast("bigint"))
    lines = lines_in_stage(spark, stage, sorted(held))
    return (
        ready.join(lines, "job_exec_id", "left")
        .fillna(0, ["line_count"])
        .where("line_count <> row_count")
    )


def purge_batches(spark: SparkSession, stage: Stage, batch_ids: list[int]) -> None:
    """Drop the files of loaded batches, the lines first."""
    for batch_id in batch_ids:
        drop_directory(spark, stage.batch_path(batch_id))
        drop_directory(spark, stage.ready_file(batch_id))


def sweep_unfinished(spark: SparkSession, stage: Stage, before: int) -> None:
    """Drop what captures numbered below ``before`` left when they failed: steps
    they had written, and lines that never became ready."""
    ready = set(subdirectories(spark, stage.ready_path, "batch="))
    for folder, spared in (("data", ready), ("work", set())):
        for name in subdirectories(spark, f"{stage.root}/{folder}", "batch="):
            if name not in spared and int(name[6:]) < before:
                drop_directory(spark, f"{stage.root}/{folder}/{name}")
