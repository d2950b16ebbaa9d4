"""Source tables: files, or the operational database."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators.joins import by_number
from orderflow.sources.change_log import ChangeLog


@dataclass(frozen=True)
class SourceTables:
    """The relations a capture reads; see the operators for their columns. The
    change log is one at rest, or any frame of salesorderid, version and op."""

    change_log: DataFrame | ChangeLog
    header: DataFrame
    detail: DataFrame
    product: DataFrame
    address: DataFrame

    def of_changes(self, net: DataFrame) -> SourceTables:
        """Header and detail of the changed orders only; ``net`` is a written
        table, so its size is known. A small one is broadcast to the scans and
        nothing else of the two tables is shuffled; one of many orders, however
        small its file, is joined by order, which the joins that follow then find
        done. The key range on top reaches the scan itself: changed orders are
        mostly recent ones. Runs a job for the range and the number of orders."""
        low, high, orders = net.agg(
            F.min("salesorderid"), F.max("salesorderid"), F.count(F.lit(1))
        ).first()
        keys = by_number(net.select("salesorderid"), orders)

        def changed(table: DataFrame) -> DataFrame:
            inside = F.col("salesorderid").between(low, high) if low is not None else F.lit(False)
            return table.where(inside).join(keys, "salesorderid", "left_semi")

        return replace(self, header=changed(self.header), detail=changed(self.detail))


def parquet_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    key_range: tuple[int, int],
    partitions: int,
    **options: str,
) -> DataFrame:
    """A database table read by ``partitions`` tasks, each with its key range.
    Credentials come as Spark options (``user``, ``password``, or better a
    connection provider)."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, **options)
        .options(
            partitionColumn=key,
            lowerBound=str(key_range[0]),
            upperBound=str(key_range[1]),
            numPartitions=str(partitions),
        )
        .load()
    )
