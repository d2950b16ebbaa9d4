"""The load as a stream over the files of the stage.

The stream takes the stage's files as they come, in any cut: the lines of a batch
and the small file with their number. Each micro-batch puts its lines into an
inbox beside the table, one folder per epoch, and then loads those batches of
which the inbox holds as many lines as they should have, by the same code as the
batch run. An order summed from half its lines would be wrong, so a batch waits
until it is whole, over as many micro-batches as it takes.

What is loaded is recorded in the table, not in a state store. An epoch that is
replayed after a failure writes the same folder of the inbox again and finds its
batches loaded. The source's files are dropped by the stream itself, after it has
noted the epoch, so that a replay still finds them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderflow.operators.wire import CORRUPT
from orderflow.plans.runs import load_lines
from orderflow.schemas import READY, WIRE
from orderflow.session import PACKING, configure
from orderflow.sources.orders_table import OrdersTable
from orderflow.sources.paths import drop_directory, subdirectories
from orderflow.sources.stage import Stage, batch_of_file, purge_batches

COUNT = "row_count"
# A line of the stage's files is a wire row, or the number of a batch's rows.
FILES = T.StructType([*WIRE, T.StructField(COUNT, T.LongType()), T.StructField(CORRUPT, T.StringType())])
INBOX = T.StructType([*FILES, T.StructField("epoch", T.LongType()), T.StructField("batch", T.LongType())])


class Inbox:
    """Lines that wait for the rest of their batch:
    <root>/epoch=<epoch>/batch=<batch>/part-*.parquet"""

    def __init__(self, root: str):
        self.root = root

    def put(self, rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").partitionBy("batch").parquet(
            f"{self.root}/epoch={epoch}", compression=PACKING
        )

    def batches(self, spark: SparkSession, epoch: int) -> set[int]:
        names = subdirectories(spark, f"{self.root}/epoch={epoch}", "batch=")
        return {int(name[6:]) for name in names}

    def lines(self, spark: SparkSession) -> DataFrame:
        if not subdirectories(spark, self.root, "epoch="):
            return spark.createDataFrame([], INBOX)
        return spark.read.schema(INBOX).parquet(self.root)

    def drop(self, spark: SparkSession, batches: set[int]) -> None:
        """Drop the lines of some batches, and epochs that are empty then."""
        for epoch in subdirectories(spark, self.root, "epoch="):
            path = f"{self.root}/{epoch}"
            for batch in subdirectories(spark, path, "batch="):
                if int(batch[6:]) in batches:
                    drop_directory(spark, f"{path}/{batch}")
            if not subdirectories(spark, path, "batch="):
                drop_directory(spark, path)


def whole_batches(lines: DataFrame) -> DataFrame:
    """job_exec_id, row_count of the batches that are whole."""
    counted = lines.groupBy("batch").agg(
        F.max(COUNT).alias(COUNT), F.count_if(F.col(COUNT).isNull()).alias("came")
    )
    whole = counted.where(F.col(COUNT) == F.col("came"))
    return whole.select(F.col("batch").alias("job_exec_id"), COUNT)


def load_inbox(
    spark: SparkSession,
    inbox: Inbox,
    table: OrdersTable,
    quarantine: str,
    mode: str = "repaired",
    null_text: str | None = None,
    on_error: str = "fail",
) -> int | None:
    """Load what is whole and not loaded yet, batch after batch, so that the table
    does not depend on how the files were cut into epochs. One number per batch
    that waits in the inbox comes to the driver. Returns the last new version."""
    lines = inbox.lines(spark)
    loaded = {r.job_exec_id for r in table.loaded_batches(spark).collect()}
    whole = whole_batches(lines).collect()
    waiting = sorted((r for r in whole if r.job_exec_id not in loaded), key=lambda r: r.job_exec_id)
    strict, version = on_error != "quarantine", None
    for batch in waiting:
        taken = lines.where(F.col(COUNT).isNull() & (F.col("batch") == batch.job_exec_id))
        version = load_lines(
            spark,
            table,
            _only_json(taken) if strict else taken.select(*WIRE.names, CORRUPT, "batch"),
            spark.createDataFrame([batch], READY),
            mode,
            null_text,
            None if strict else quarantine,
            [r.job_exec_id for r in whole],
        )
    # A batch of which only a part came again was loaded by another run.
    some = {r.batch for r in lines.select("batch").distinct().collect()}
    inbox.drop(spark, {r.job_exec_id for r in waiting} | (some & loaded))
    return version


def _only_json(lines: DataFrame) -> DataFrame:
    """The wire rows; a line that is no JSON is an error."""
    error = F.concat(F.lit("a line of the stage is no JSON: "), F.col(CORRUPT))
    order = F.when(F.col(CORRUPT).isNull(), F.col("salesorderid"))
    order = order.otherwise(F.raise_error(error).cast("string"))
    return lines.withColumn("salesorderid", order).select(*WIRE.names, "batch")


def start_load_stream(
    spark: SparkSession,
    stage: Stage,
    table: OrdersTable,
    checkpoint: str,
    files_per_trigger: int = 1000,
    processing_time: str | None = None,
    clean_files: str = "delete",
    **options,
) -> StreamingQuery:
    """Start the load. Without a ``processing_time`` it takes what is there and
    ends. ``clean_files`` says what becomes of files that were read (``delete`` or
    ``off``). ``options`` go to ``load_inbox``."""
    configure(spark)
    files = (
        spark.readStream.schema(FILES)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("cleanSource", clean_files)
        .json(stage.files)
        .select(*FILES.names, batch_of_file().alias("batch"))
    )
    inbox = Inbox(f"{table.root}/inbox")

    def load(rows: DataFrame, epoch: int) -> None:
        session = rows.sparkSession
        inbox.put(rows, epoch)
        if clean_files == "delete":
            # Of batches loaded in epochs that are noted, the folders go as well.
            came = inbox.batches(session, epoch)
            loaded = {r.job_exec_id for r in table.loaded_batches(session).collect()}
            purge_batches(session, stage, sorted(loaded - came))
        load_inbox(session, inbox, table, stage.quarantine_path, **options)

    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
    return (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
