"""Narrow price fact: label and city are not stored, they come from the
station version in force on the collection date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.functions.keys import version_key
from pricegrid.operators import checks, scd2

FACT_COLUMNS = ["collection_date", "station_key", "product_key", "sale_price", "source_file"]


def build_stored(obs: DataFrame, dim_station: DataFrame, dim_product: DataFrame) -> DataFrame:
    """observation -> version in force (as-of) -> product key (equi). Rows hold the natural
    key of their version in place of its hash."""
    narrow = obs.select(scd2.KEY, scd2.DATE, "product", "sale_price", "source_file")
    f = scd2.as_of(narrow, dim_station, carry=["valid_from"])
    p = dim_product.select("product_key", F.col("source_product_name").alias("_pname"))
    f = f.join(p, f["product"] == p["_pname"])
    return f.select(scd2.DATE, scd2.KEY, "valid_from", "product_key", "sale_price", "source_file")


def with_station_key(rows: DataFrame) -> DataFrame:
    """The fact with the natural key of each row's version beside its station key."""
    return rows.withColumn("station_key", version_key(scd2.KEY, "valid_from")).select(*FACT_COLUMNS, scd2.KEY, "valid_from")


def build(obs: DataFrame, dim_station: DataFrame, dim_product: DataFrame) -> DataFrame:
    return with_station_key(build_stored(obs, dim_station, dim_product)).select(*FACT_COLUMNS)


def reconcile(obs: DataFrame, fact: DataFrame) -> DataFrame:
    """Row check: the interval join may neither lose nor multiply rows."""
    return checks.reconcile(observations=obs, fact_rows=fact)
