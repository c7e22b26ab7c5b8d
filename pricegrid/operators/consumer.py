"""Consumer queries on the fact: selective filter, broad aggregate, lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.operators import scd2


def _avg(col: str):
    return F.try_divide(F.sum(col).cast("double"), F.count(F.lit(1)))


def selective(fact: DataFrame, dim_product: DataFrame, date_from: str, date_to: str,
              product_name: str) -> DataFrame:
    """Count and average price of one product in a date range. The product
    key is a scalar subquery; date and key filters reach the fact scan."""
    key = dim_product.where(F.col("product_name") == product_name).select("product_key").scalar()
    f = fact.where(F.col("collection_date").between(F.lit(date_from).cast("date"),
                                                    F.lit(date_to).cast("date"))
                   & (F.col("product_key") == key))
    return f.agg(F.count(F.lit(1)).alias("n"), _avg("sale_price").alias("avg_price"))


def broad(fact: DataFrame, dim_station: DataFrame) -> DataFrame:
    """Median price per (state, year) over the whole fact. Prices are counted
    per (state, year, price) first, by as many tasks as there are prices; the
    few groups then take a weighted percentile of distinct prices."""
    counted = (scd2.join_versions(fact, dim_station, ["state"])
               .groupBy("state", F.year("collection_date").cast("bigint").alias("year"), "sale_price")
               .agg(F.count(F.lit(1)).alias("n")))
    return (counted.groupBy("state", "year")
            .agg(F.round(F.percentile(F.col("sale_price").cast("double"), 0.5, F.col("n")), 4)
                 .alias("median_price")))


def lookup(fact: DataFrame, dim_station: DataFrame, cnpj: str) -> DataFrame:
    """Count, min and max price of one station (all its versions)."""
    s = dim_station.where(F.col("reseller_cnpj") == cnpj).select("station_key")
    return (fact.join(s, "station_key")
            .agg(F.count(F.lit(1)).alias("n"), F.min("sale_price").alias("min_price"),
                 F.max("sale_price").alias("max_price")))
