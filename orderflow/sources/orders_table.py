"""The order table as parquet files.

Parquet has no row-level MERGE, so a load rewrites what it touches. The table is
cut by ranges of the order key into buckets; a load reads and rewrites only the
buckets its orders fall into, next to the old ones, and then publishes all of
them with one small file:

    <root>/data/v=<version>/order_bucket=<b>/part-*.parquet
    <root>/commits/v=<version>/part-*.json

A commit lists for every bucket the version that holds its rows, and all capture
batches loaded so far. Until it is there, readers see the version before; a load
that is run again overwrites only its own unpublished files.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators.constraints import OF_ORDERS, enforced
from orderflow.schemas import ORDERS
from orderflow.session import PACKING
from orderflow.sources.paths import drop_directory, exists, subdirectories

_COMMIT = "kind string, id bigint, holder bigint"
BUCKET, BATCH = "bucket", "batch"


def no_orders(spark: SparkSession) -> DataFrame:
    """A table without rows that Catalyst knows to have none, so that joins to it
    are left out of the plan and nothing is shuffled for them."""
    return spark.createDataFrame([], ORDERS).limit(0)


@dataclass(frozen=True)
class OrdersTable:
    """``orders_per_bucket`` sets the size of a rewrite and the number of
    buckets (highest key / orders_per_bucket); the list of buckets is the only
    thing the driver holds. ``versions_kept`` are readable, the current one
    included; what only older ones hold is dropped."""

    root: str
    orders_per_bucket: int = 10_000_000
    versions_kept: int = 2

    def bucket_of(self, order: Column) -> Column:
        return F.floor(order / self.orders_per_bucket).cast("bigint")

    def buckets(self, rows: DataFrame) -> list[int]:
        """The buckets of ``rows``, one number each. Runs a job."""
        found = rows.select(self.bucket_of(F.col("salesorderid")).alias("b")).distinct()
        return sorted(r.b for r in found.collect())

    def version(self, spark: SparkSession) -> int:
        """The published version, 0 before the first load. Lists file names,
        one per version kept; no job."""
        path = f"{self.root}/commits"
        if not exists(spark, path):
            return 0
        files = spark.read.schema(_COMMIT).json(path).inputFiles()
        return max((int(re.search(r"/v=(\d+)/", f).group(1)) for f in files), default=0)

    def _committed(self, spark: SparkSession, version: int, kind: str) -> DataFrame:
        if version == 0:
            return spark.createDataFrame([], _COMMIT)
        commit = spark.read.schema(_COMMIT).json(self._commit_path(version))
        return commit.where(F.col("kind") == kind)

    def loaded_batches(self, spark: SparkSession) -> DataFrame:
        """The batches (``job_exec_id``) that are loaded and may still be offered:
        those of the last load, and earlier ones that were in the stage then."""
        batches = self._committed(spark, self.version(spark), BATCH)
        return batches.select(F.col("id").alias("job_exec_id"))

    def holders(self, spark: SparkSession, version: int) -> dict[int, int]:
        """Bucket -> version that holds its rows, as of ``version``."""
        buckets = self._committed(spark, version, BUCKET)
        return {r.id: r.holder for r in buckets.select("id", "holder").collect()}

    def read(
        self,
        spark: SparkSession,
        version: int | None = None,
        buckets: list[int] | None = None,
    ) -> DataFrame:
        """All rows, or those of some buckets, as of a version."""
        version = self.version(spark) if version is None else version
        holders = self.holders(spark, version)
        wanted = holders if buckets is None else [b for b in buckets if b in holders]
        paths = [self._bucket_path(holders[b], b) for b in wanted]
        if not paths:
            return no_orders(spark)
        return spark.read.schema(ORDERS).parquet(*paths)

    def publish(
        self,
        rows: DataFrame,
        version: int,
        buckets: list[int],
        batch_ids: list[int],
        offered: list[int] | None = None,
    ) -> None:
        """Write the rewritten buckets as ``version`` and make it the current
        one. Large buckets are written by many tasks, small ones by one. Only
        buckets that have come to rows are committed. Of the batches loaded
        before, those still ``offered`` are noted again (all, if that is None)."""
        spark = rows.sparkSession
        (
            enforced(rows, OF_ORDERS)
            .withColumn("order_bucket", self.bucket_of(F.col("salesorderid")))
            .hint("rebalance", F.col("order_bucket"))
            .write.mode("overwrite")
            .partitionBy("order_bucket")
            .parquet(f"{self.root}/data/v={version}", compression=PACKING)
        )
        before = self.version(spark)
        folders = subdirectories(spark, f"{self.root}/data/v={version}", "order_bucket=")
        written = {int(name.removeprefix("order_bucket=")) for name in folders}
        if not written <= set(buckets):
            raise ValueError(f"rows of other buckets: {sorted(written - set(buckets))}")
        holders = {b: v for b, v in self.holders(spark, before).items() if b not in buckets}
        holders |= dict.fromkeys(written, version)
        batches = {r.job_exec_id for r in self.loaded_batches(spark).collect()}
        batches = (batches if offered is None else batches & set(offered)) | set(batch_ids)
        entries = [(BUCKET, b, v) for b, v in sorted(holders.items())]
        entries += [(BATCH, b, version) for b in sorted(batches)]
        (
            spark.createDataFrame(entries, _COMMIT)
            .coalesce(1)
            .write.mode("overwrite")
            .json(self._commit_path(version))
        )

    def drop_expired(self, spark: SparkSession) -> None:
        """Drop the versions beyond those kept, and what failed loads have left.
        Only one load writes at a time."""
        current = self.version(spark)
        for version in self._versions(spark):
            if version <= current - self.versions_kept:
                self.drop_superseded(spark, version)
        for folder in ("data", "staging"):
            for name in subdirectories(spark, f"{self.root}/{folder}", "v="):
                if int(name[2:]) > current:
                    drop_directory(spark, f"{self.root}/{folder}/{name}")

    def _versions(self, spark: SparkSession) -> list[int]:
        return [int(n[2:]) for n in subdirectories(spark, f"{self.root}/commits", "v=")]

    def drop_superseded(self, spark: SparkSession, version: int) -> None:
        """Drop an older version's commit, and its bucket files that no later
        version holds. Only for a version nothing reads."""
        current = self.version(spark)
        if version >= current:
            raise ValueError(f"version {version} is not older than {current}")
        later = [v for v in self._versions(spark) if version < v <= current]
        held = {item for v in later for item in self.holders(spark, v).items()}
        for bucket, holder in self.holders(spark, version).items():
            if (bucket, holder) not in held:
                drop_directory(spark, self._bucket_path(holder, bucket))
                if not subdirectories(spark, f"{self.root}/data/v={holder}", "order_bucket="):
                    drop_directory(spark, f"{self.root}/data/v={holder}")
        drop_directory(spark, self._commit_path(version))

    def _bucket_path(self, version: int, bucket: int) -> str:
        return f"{self.root}/data/v={version}/order_bucket={bucket}"

    def _commit_path(self, version: int) -> str:
        return f"{self.root}/commits/v={version}"
