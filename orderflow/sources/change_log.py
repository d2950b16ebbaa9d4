"""The change log at rest, partitioned by ranges of versions.

    <root>/data/version_part=<n>/part-*.parquet    versions n * width to (n + 1) * width - 1
    <root>/retention/valid_from=<version>/         the highest version cleaned up
    <root>/spans/parts=<n>/                        the most parts that lie in one folder

A capture reads the partitions of its range and no older one. Retention drops
whole partitions and notes first up to which version changes are gone, so the
log itself tells whether a range is still complete.

A file costs far more than the few rows of a narrow part. So an append of more than
``FOLDERS_AT_ONCE`` parts puts 2, 4, 8 ... of them into one folder, named by the first.
Retention still goes by part: what is gone of a folder that is kept is not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.operators.changes import RETENTION_DAYS
from orderflow.schemas import CHANGE_LOG
from orderflow.sources.paths import drop_directory, has_entries, make_directory, subdirectories

PART = "version_part"
FOLDERS_AT_ONCE = 1024  # that an append makes
FOLDERS_READ_AT_ONCE = 4096  # by retention


@dataclass(frozen=True)
class ChangeLog:
    root: str
    versions_per_part: int = 1_000_000

    @property
    def _data(self) -> str:
        return f"{self.root}/data"

    def append(self, changes: DataFrame) -> None:
        """Add changes (salesorderid, version, op, and changed_at if it is known).
        A large folder is written by many tasks, a small one by one. Runs a job for
        the range of versions."""
        known = [
            F.col(f.name) if f.name in changes.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in CHANGE_LOG
        ]
        low, high = changes.select(F.min(self._part), F.max(self._part)).first()
        span = 1
        while low is not None and (high - low) // span >= FOLDERS_AT_ONCE:
            span *= 2
        if span > 1:
            make_directory(changes.sparkSession, f"{self.root}/spans/parts={span}")
        (
            changes.select(known)
            .withColumn(PART, self._part - F.pmod(self._part, F.lit(span)))
            .hint("rebalance", F.col(PART))
            .write.mode("append")
            .partitionBy(PART)
            .parquet(self._data)
        )

    @property
    def _part(self) -> Column:
        return F.expr(f"version div {self.versions_per_part}L")

    def span(self, spark: SparkSession) -> int:
        """A part may lie in a folder of its own number or of one that is less by
        fewer than this; the folders of a span begin at its multiples."""
        names = subdirectories(spark, f"{self.root}/spans", "parts=")
        return max((int(n.split("=")[1]) for n in names), default=1)

    def parts(self, spark: SparkSession) -> list[int]:
        """Numbers of the folders, from the listing."""
        return sorted(int(n.split("=")[1]) for n in subdirectories(spark, self._data, f"{PART}="))

    def read(self, spark: SparkSession, parts: list[int] | None = None) -> DataFrame:
        """All changes, or those of some folders (the others are not listed)."""
        schema = T.StructType([*CHANGE_LOG, T.StructField(PART, T.LongType())])
        if not has_entries(spark, self._data):
            return spark.createDataFrame([], schema)
        files = spark.read.schema(schema).option("basePath", self._data)
        rows = files.parquet(*([self._data] if parts is None else [f"{self._data}/{PART}={p}" for p in parts]))
        valid = self._valid_from(spark) if self.span(spark) > 1 else None
        return rows if valid is None else rows.where((F.col("version") > valid) | F.col("version").isNull())

    def between(self, spark: SparkSession, since: int, until: int | None = None) -> DataFrame:
        """Changes in ``(since, until]``: other partitions are not even listed."""
        first = (since + 1) // self.versions_per_part
        inside = (F.col("version") > since) & (F.col(PART) >= first - first % self.span(spark))
        if until is not None:
            inside &= (F.col("version") <= until) & (F.col(PART) <= until // self.versions_per_part)
        return self.read(spark).where(inside).drop(PART)

    def after(self, mark: DataFrame) -> DataFrame:
        """Changes after the version in ``mark`` (one row, ``db_chg_version_id``).
        The mark is read by the same query: it becomes the list of partitions from
        its own on, and Spark prunes the log by that list when the query runs."""
        spark = mark.sparkSession
        newest = max(self.parts(spark), default=0)
        part = F.expr(f"(since + 1L) div {self.versions_per_part}L")
        first = part - F.pmod(part, F.lit(self.span(spark)))
        wanted = mark.select(F.col("db_chg_version_id").alias("since")).select(
            "since",
            F.explode(
                F.when(first <= newest, F.sequence(first, F.lit(newest).cast("bigint"))).otherwise(
                    F.array().cast("array<bigint>")
                )
            ).alias(PART),
        )
        log = self.read(spark)
        return (
            log.join(F.broadcast(wanted.where(F.col(PART) >= 0)), PART)
            .where(F.col("version") > F.col("since"))
            .drop(PART, "since")
        )

    def newest_version(self, spark: SparkSession) -> DataFrame:
        """One row, ``version``: the highest in the newest partition, from the
        footers of its files and those that may reach beyond. Only the newer
        Parquet source pushes such an aggregate down, so it is asked for in a
        session of its own."""
        footers = spark.newSession()
        footers.conf.set("spark.sql.sources.useV1SourceList", "")
        footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        parts = self.parts(spark)
        newest = [p for p in parts if p > parts[-1] - self.span(spark)]
        files = footers.read.schema(CHANGE_LOG).parquet(*[f"{self._data}/{PART}={p}" for p in newest])
        return files.agg(F.max("version").alias("version"))

    def current_version(self, spark: SparkSession) -> int:
        """0 for an empty log; never below what has been cleaned up."""
        found = self.newest_version(spark).first()["version"] if self.parts(spark) else 0
        return max(found, self.min_valid_version(spark))

    def min_valid_version(self, spark: SparkSession) -> int:
        """Changes since a lower version than this are no longer complete."""
        return self._valid_from(spark) or 0

    def _valid_from(self, spark: SparkSession) -> int | None:
        names = subdirectories(spark, f"{self.root}/retention", "valid_from=")
        return max((int(n.split("=")[1]) for n in names), default=None)

    def clean(self, spark: SparkSession, now: datetime, days: int = RETENTION_DAYS) -> int:
        """Drop the partitions that hold nothing newer than ``days``, but never the
        newest nor one behind a kept one. Returns the lowest valid version."""
        until = F.lit(now - timedelta(days=days)).cast("timestamp_ntz")
        folders, span = self.parts(spark), self.span(spark)
        if not folders:
            return self.min_valid_version(spark)
        newest = folders[-1]
        if span > 1:
            newest = self.newest_version(spark).select(self._part).first()[0]
        kept = valid = None
        done, most = folders[0], 1
        while kept is None:
            # From the oldest on, ever more at a time: what is kept is hardly read.
            # Parts below the next folder lie wholly in those asked.
            rest = [f for f in folders if f > done - span]
            asked, beyond = rest[:most], rest[most : most + 1]
            whole = (F.col("part") >= done) & (F.col("part") < beyond[0] if beyond else F.lit(True))
            ages = (
                self.read(spark, asked)
                .groupBy(self._part.alias("part"))
                .agg((F.max("changed_at") < until).alias("expired"), F.max("version").alias("highest"))
                .where(whole)
            )
            stays = ~F.coalesce("expired", F.lit(False)) | (F.col("part") == newest)
            kept = ages.where(stays).agg(F.min("part")).first()[0]
            old = ages if kept is None else ages.where(F.col("part") < kept)
            highest = old.agg(F.max("highest")).first()[0]
            valid = valid if highest is None else highest
            if not beyond:
                break
            done, most = beyond[0], min(2 * most, FOLDERS_READ_AT_ONCE)
        if kept is None or valid is None:
            return self.min_valid_version(spark)
        make_directory(spark, f"{self.root}/retention/valid_from={valid}")
        edge, held = [f for f in folders if kept - span < f < kept], set()
        if edge:
            alive = self.read(spark, edge).where(self._part >= kept)
            held = {r[PART] for r in alive.select(PART).distinct().collect()}
        for folder in folders:
            if folder < kept and folder not in held:
                drop_directory(spark, f"{self._data}/{PART}={folder}")
        for name in subdirectories(spark, f"{self.root}/retention", "valid_from="):
            if int(name.split("=")[1]) < valid:
                drop_directory(spark, f"{self.root}/retention/{name}")
        return self.min_valid_version(spark)
