"""Directory steps on any file system Hadoop knows. Metadata only: no data
passes through the driver."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def drop_directory(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)


def subdirectories(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names of the folders in a folder; none if it is not there. All names come in
    one answer of the JVM: a question for each takes longer than the listing."""
    fs, at = _at(spark, path)
    if not fs.exists(at):
        return []
    found = spark._jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(fs.listStatus(at)).mkString("\n")
    names = re.findall(r"^\w+\{path=.*/(.+?); isDirectory=true;", found, re.MULTILINE)
    return sorted(name for name in names if name.startswith(prefix))


def has_entries(spark: SparkSession, path: str) -> bool:
    """Whether anything is in a folder; it need not be there."""
    fs, at = _at(spark, path)
    return fs.exists(at) and fs.listStatusIterator(at).hasNext()


def make_directory(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.mkdirs(at)
