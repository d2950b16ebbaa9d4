"""The engine's inputs derived from the test tables.

The change log and the state of the source at a version follow fixed rules over
all orders: every order is inserted, every fourth updated, every tenth deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.functions.text import as_text
from orderflow.operators.joins import children_of, fan_out
from orderflow.operators.nested import nest_details
from orderflow.session import settle_into, shared_dir
from orderflow.sources.change_log import ChangeLog
from orderflow.sources.stage import Stage, mark_ready
from orderflow.sources.tables import SourceTables, parquet_table

FIRST = (0, 59)  # version range of batch 1: all inserts
SECOND = (59, 1000)  # of batch 2: updates and deletes
BEFORE_DELETES = 89  # every update done, no delete yet

def _versions(key: Column) -> dict[str, Column]:
    """Per operation, the version at which it happens to an order, or NULL."""
    return {
        "I": (1 + key % 50).cast("bigint"),
        "U": F.when(key % 4 == 0, (60 + key % 20).cast("bigint")),
        "D": F.when(key % 10 == 0, (90 + F.floor((key % 100) / 10)).cast("bigint")),
    }


def _done(op: str, key: Column, until: int) -> Column:
    return F.coalesce(_versions(key)[op] <= until, F.lit(False))


def _stands(key: Column, until: int) -> Column:
    return _done("I", key, until) & ~_done("D", key, until)


class SampleTables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return parquet_table(self.spark, self.sf_dir, name)

    def change_log(self) -> DataFrame:
        key = F.col("o_orderkey")
        changes = F.array(
            *[
                F.struct(version.alias("version"), F.lit(op).alias("op"))
                for op, version in _versions(key).items()
            ]
        )
        return (
            self.table("orders")
            .select(key.alias("salesorderid"), F.explode(changes).alias("change"))
            .select("salesorderid", "change.version", "change.op")
            .where(F.col("version").isNotNull())
        )

    def log_at_rest(self, versions_per_part: int = 10) -> ChangeLog:
        log = ChangeLog(f"{shared_dir(self.spark)}/log", versions_per_part)
        log.append(self.change_log())
        return log

    def header(self, until: int) -> DataFrame:
        """Orders standing at a version; an update moves the time by a day."""
        key = F.col("o_orderkey")
        shift = F.make_dt_interval(
            days=_done("U", key, until).cast("int"), hours=(key % 24).cast("int")
        )
        return (
            self.table("orders")
            .where(_stands(key, until))
            .select(
                key.alias("salesorderid"),
                F.col("o_custkey").alias("shiptoaddressid"),
                F.col("o_orderdate").alias("orderdate"),
                (F.col("o_orderdate") + shift).alias("modifieddate"),
            )
        )

    def detail(self, until: int) -> DataFrame:
        """Lines of those orders; an update adds one to each quantity."""
        key = F.col("l_orderkey")
        price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
        return (
            self.table("lineitem")
            .where(_stands(key, until))
            .select(
                key.alias("salesorderid"),
                F.col("l_partkey").alias("productid"),
                (F.col("l_quantity").cast("int") + _done("U", key, until).cast("int")).alias(
                    "orderqty"
                ),
                price.cast("decimal(18,4)").alias("linetotal"),
            )
        )

    def product(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("productid"), F.col("p_name").alias("name")
        )

    def address(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("addressid"),
            F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("postalcode"),
        )

    def sources(self, until: int) -> SourceTables:
        """All source tables as a capture finds them at a version."""
        return SourceTables(
            self.change_log().where(F.col("version") <= until),
            self.header(until),
            self.detail(until),
            self.product(),
            self.address(),
        )

    def ledger(self) -> DataFrame:
        failed = F.col("event_type") == "error"
        end = F.col("ts") + F.make_dt_interval(mins=F.lit(5))
        return self.table("events").select(
            F.col("event_id").alias("job_exec_id"),
            F.when(failed, None).otherwise(0).cast("int").alias("job_exec_status"),
            (F.col("event_id") * 10).alias("db_chg_version_id"),
            F.col("ts").alias("job_start_ts"),
            F.when(~failed, end).alias("job_end_ts"),
        )

    def event_log(self) -> DataFrame:
        """A change log with times, for the retention rule."""
        op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D")
        return self.table("events").select(
            F.col("user_id").alias("salesorderid"),
            F.col("event_id").alias("version"),
            op.otherwise("U").alias("op"),
            F.col("ts").alias("changed_at"),
        )

    def break_lines(self, captured: DataFrame, stage: Stage, batch_id: int) -> None:
        """A batch in the stage of which some lines are cut off and some hold a word
        for a quantity, by the remainder of order and product."""
        rule = (F.col("salesorderid") + F.coalesce("ProductID", F.lit(0))) % 97
        wire = captured.select(rule.alias("rule"), *[as_text(c) for c in captured.columns])
        many = F.when((F.col("rule") == 1) & F.col("productorderqty").isNotNull(), "many")
        wire = wire.withColumn("productorderqty", many.otherwise(F.col("productorderqty")))
        whole = F.to_json(F.struct(*captured.columns))
        kept = F.when(F.col("rule") == 0, F.floor(F.length("value") * 0.6)).otherwise(F.length("value"))
        lines = wire.withColumn("value", whole).select(F.substr("value", F.lit(1), kept.cast("int")))
        lines.write.mode("overwrite").text(stage.batch_path(batch_id))
        mark_ready(self.spark, stage, batch_id, captured.count())

    def nested_orders(self) -> DataFrame:
        headers = self.table("orders").select(
            F.col("o_orderkey").alias("salesorderid"),
            F.col("o_custkey").alias("customerid"),
            F.col("o_orderdate").alias("orderdate"),
            F.col("o_totalprice").alias("subtotal"),
        )
        lines = self.table("lineitem").select(
            F.col("l_orderkey").alias("salesorderid"),
            F.col("l_partkey").alias("productid"),
            F.col("l_suppkey").alias("specialofferid"),
            F.col("l_quantity").cast("int").alias("orderqty"),
            F.col("l_extendedprice").alias("unitprice"),
            F.col("l_discount").alias("unitpricediscount"),
        )
        documents = settle_into(shared_dir(self.spark))(nest_details(lines), "documents")
        return fan_out(headers, documents, "salesorderid")

    def persons(self) -> DataFrame:
        """The customer behind each order, so persons repeat."""
        buyers = self.table("orders").select(F.col("o_custkey").alias("c_custkey"))
        return children_of(self.table("customer"), buyers, "c_custkey").select(
            F.col("c_mktsegment").alias("firstname"),
            F.col("c_name").alias("lastname"),
            F.col("c_custkey").alias("businessentityid"),
        )

    def person_addresses(self) -> DataFrame:
        nation = self.table("nation").withColumnRenamed("n_nationkey", "c_nationkey")
        return children_of(nation, self.table("customer"), "c_nationkey").select(
            F.col("c_mktsegment").alias("addressline1"),
            F.col("n_name").alias("city"),
            F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("postalcode"),
        )
