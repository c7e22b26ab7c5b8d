"""Conformed dimensions: calendar, city, product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.functions.keys import natural_key


def calendar(dates: DataFrame, date: str = "collection_date") -> DataFrame:
    """One row per day from the Monday of the first week to the Sunday of the
    last week seen in ``dates`` (range from the data, not fixed).

    The bounds are one aggregate row; the day series it explodes is bounded by
    the date domain (366 rows per year), so a single task generating it is
    size-safe.
    """
    bounds = dates.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    lo = F.date_trunc("week", F.col("lo")).cast("date")
    hi = F.date_add(F.date_trunc("week", F.col("hi")).cast("date"), 6)
    days = bounds.select(F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return with_calendar(days, "full_date")


def with_calendar(df: DataFrame, d: str = "full_date") -> DataFrame:
    c = F.col(d)
    iso_year = F.extract(F.lit("YEAROFWEEK"), c).cast("bigint")
    iso_week = F.weekofyear(c).cast("bigint")
    return df.select(
        c.alias("full_date"),
        (iso_year * 100 + iso_week).alias("survey_week_key"),
        F.date_trunc("week", c).cast("date").alias("week_start_date"),
        iso_year.alias("iso_year"),
        iso_week.alias("iso_week"),
        F.date_trunc("month", c).cast("date").alias("month_start_date"),
        F.year(c).cast("bigint").alias("calendar_year"),
        F.quarter(c).cast("bigint").alias("calendar_quarter"),
        F.dayofweek(c).cast("bigint").alias("day_of_week"),
    )


def city(obs: DataFrame) -> DataFrame:
    """One row per (city, state, region); key = sha2(state|city).

    The survey groups by region too but keys without it; ``check_unique``
    must run on the result (a city under two regions would repeat its key).
    """
    return (obs.groupBy("city", "state", "region")
            .agg(F.count_distinct("reseller_cnpj").alias("stations"))
            .select(natural_key("state", "city").alias("city_key"),
                    F.col("city").alias("city_name"), F.col("state").alias("uf"),
                    "region", "stations"))


def homonyms(city_dim: DataFrame) -> DataFrame:
    """City names present in more than one state, states sorted. The list per
    name is bounded by the number of states."""
    return (city_dim.groupBy("city_name")
            .agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("uf")).alias("ufs"))
            .where(F.col("n") > 1).drop("n"))


def product(obs: DataFrame, curated: DataFrame) -> DataFrame:
    """Products seen in the data, with curated names where the map has them.
    AQE broadcasts the curated map when its measured bytes allow it."""
    o = obs.groupBy("product").agg(F.count(F.lit(1)).alias("observations"))
    c = curated.withColumnRenamed("unit_of_measure", "_unit")
    j = o.join(c, o["product"] == c["source_product_name"], "left")
    return j.select(
        natural_key("product").alias("product_key"),
        F.col("product").alias("source_product_name"),
        F.coalesce(c["product_name"], F.col("product")).alias("product_name"),
        c["fuel_family"],
        F.col("_unit").alias("unit_of_measure"),
        F.coalesce(c["is_liquid_fuel"], F.lit(True)).alias("is_liquid_fuel"),
        F.coalesce(c["in_default_scope"], F.lit(True)).alias("in_default_scope"),
        c["product_name"].isNotNull().alias("is_curated"),
        "observations",
    )


def uncurated(product_dim: DataFrame) -> DataFrame:
    return (product_dim.where(~F.col("is_curated"))
            .select("source_product_name", "observations")
            .orderBy(F.desc("observations"), "source_product_name"))
