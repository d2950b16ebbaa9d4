"""Session settings the operators count on, and the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# A step whose result is read more than once is handed to a settle function
# with a name. The runs write it out as a table: that cuts the lineage, so a
# lost executor costs no recomputation of earlier stages, and it gives Catalyst
# the true size before it decides what to broadcast.
Settle = Callable[[DataFrame, str], DataFrame]

# Of the order tables' steps and files.
PACKING = "zstd"


def unsettled(df: DataFrame, name: str) -> DataFrame:
    return df


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings. Hot keys are split by the adaptive skew join, also
    where that means one more shuffle behind the join. An aggregate shuffles by
    all of its keys, never by a part (the order) that may be hot."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.requireAllClusterKeysForDistribution", "true")
    # Folders are listed by a few tasks per core, not by a task for each folder.
    tasks = 4 * spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(tasks))
    return spark


def local_session(cpus: str | int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("orderflow")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # Call sites for error messages cost several JVM round trips per column.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the one the cluster names for checkpoints. Only a
    local session without that setting gets a folder of this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="orderflow-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def with_checkpoint_dir(spark: SparkSession) -> SparkSession:
    """Let ``DataFrame.checkpoint`` find a folder, as above."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return spark


def settle_into(root: str, compression: str | None = None) -> Settle:
    """Write each named step below ``root`` and go on from the written table.
    ``compression`` is Parquet's; without it, the session's."""

    def settle(df: DataFrame, name: str) -> DataFrame:
        path = f"{root}/{name}"
        df.write.mode("overwrite").parquet(path, compression=compression)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return settle
