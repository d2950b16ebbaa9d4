"""Dense surrogate keys for appended rows."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.session import with_checkpoint_dir

# monotonically_increasing_id: partition number above, row position below.
_POSITION_BITS = 33


def assign_keys(rows: DataFrame, order_by: list[str], key: str, start: int) -> DataFrame:
    """Number ``rows`` start+1, start+2, ... in the order of ``order_by``. Runs jobs.

    The rows are range-partitioned and sorted, then checkpointed, so that the
    counts and the numbers come from the same partitions even if an executor is
    lost in between. A row's number is its position within the partition plus
    the rows of the partitions before. Equal keys are spread by a random last
    sort column, so a value held by a third of the rows still fills many ranges.
    """
    with_checkpoint_dir(rows.sparkSession)
    spread = rows.withColumn("_spread", F.rand(seed=17))
    laid_out = (
        spread.repartitionByRange(*order_by, "_spread")
        .sortWithinPartitions(*order_by, "_spread")
        .drop("_spread")
        .checkpoint()
        .withColumn("_partition", F.spark_partition_id())
        .withColumn(
            "_position",
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
        )
    )
    # One row per shuffle partition, whatever the number of rows.
    sizes = {r["_partition"]: r["count"] for r in laid_out.groupBy("_partition").count().collect()}
    partitions = sorted(sizes)
    before = accumulate((sizes[p] for p in partitions), initial=start)
    offsets = rows.sparkSession.createDataFrame(
        list(zip(partitions, before)), "_partition int, _before bigint"
    )
    return laid_out.join(F.broadcast(offsets), "_partition").select(
        (F.col("_before") + F.col("_position") + 1).alias(key), *rows.columns
    )
