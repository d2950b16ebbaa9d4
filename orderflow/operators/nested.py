"""Nested orders: a header with ``orderdetails``, an array of structs.

A large order may come as several documents with the same header, so that no
document grows with the order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY, DETAILS = "salesorderid", "orderdetails"
LINES_PER_DOCUMENT = 1000


def split_orders(orders: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Headers and lines of nested orders, as tables below ``path``. The documents
    are read once: each gives its header and its lines, which are written apart by
    kind. One header row per order, however many documents it came in; an order
    without lines has a header all the same."""
    spark, header = orders.sparkSession, [c for c in orders.columns if c != DETAILS]
    line = orders.schema[DETAILS].dataType.elementType
    # A NULL line stands for the header.
    with_header = F.concat(F.array(F.lit(None).cast(line)), F.coalesce(DETAILS, F.array().cast(T.ArrayType(line))))
    rows = orders.select(*header, F.explode(with_header).alias("line"))
    is_header = F.col("line").isNull()
    written = rows.select(
        KEY,
        *[F.when(is_header, F.col(c)).alias(c) for c in header if c != KEY],
        "line",
        F.when(is_header, "header").otherwise("line").alias("kind"),
    )
    written.write.mode("overwrite").partitionBy("kind").parquet(path)
    schema = T.StructType([f for f in written.schema if f.name != "kind"])
    read = lambda kind: spark.read.schema(schema).parquet(f"{path}/kind={kind}")
    return read("header").select(header).distinct(), read("line").select(KEY, "line.*")


def nest_details(detail: DataFrame, lines_per_document: int = LINES_PER_DOCUMENT) -> DataFrame:
    """The opposite: documents of at most ``lines_per_document`` lines. Input
    rows that stand together share a document number, so the bound holds for an
    order of any size without counting its lines first."""
    lines = F.struct(*[c for c in detail.columns if c != KEY])
    return (
        detail.withColumn(
            "document", F.floor(F.monotonically_increasing_id() / lines_per_document)
        )
        .groupBy(KEY, "document")
        .agg(F.collect_list(lines).alias(DETAILS))
        .drop("document")
    )
