"""Distinct scans and value domains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_persons(person: DataFrame) -> DataFrame:
    return person.select("firstname", "lastname", "businessentityid").distinct()


def distinct_addresses(address: DataFrame) -> DataFrame:
    return address.select("addressline1", "city", "postalcode").distinct()


def _long_form(table: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    pairs = [
        F.struct(F.lit(name).alias("domain"), F.col(name).cast("string").alias("value"))
        for name in columns
    ]
    return table.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.*")


def column_domains(person: DataFrame, address: DataFrame) -> DataFrame:
    """The distinct values of six columns as (domain, value): each table is
    scanned once and all six domains share one shuffle."""
    persons = _long_form(person, ("firstname", "lastname", "businessentityid"))
    addresses = _long_form(address, ("addressline1", "city", "postalcode"))
    return persons.unionByName(addresses).distinct()


def key_domains(
    state: DataFrame, address: DataFrame, customer: DataFrame, offer: DataFrame
) -> DataFrame:
    """The key scans in one relation: (domain, id, offer id)."""

    def keys(domain: str, table: DataFrame, key: str, second: str | None = None) -> DataFrame:
        other = F.col(second) if second else F.lit(None)
        return table.select(
            F.lit(domain).alias("domain"),
            F.col(key).cast("bigint").alias("id"),
            other.cast("bigint").alias("specialofferid"),
        )

    return (
        keys("stateprovince", state, "stateprovinceid")
        .unionByName(keys("address", address, "addressid"))
        .unionByName(keys("customer", customer, "customerid"))
        .unionByName(keys("specialofferproduct", offer, "productid", "specialofferid"))
    )
