"""Weekly rollup with exact percentiles, edge-week flag and coverage.

Percentiles are exact (linear interpolation), never approximate, and stations are
counted exactly, both behind ONE exchange on the group: the narrow joined rows are
partitioned by the group key, and there a group's prices and distinct stations are
collected, sorted once and read at the percentiles' places. Nothing wide is buffered
below that exchange. A group is collected only up to ``HOT_ROWS`` rows; larger ones are
found by exact counts first (their week and product, from the fact alone, tell whether
there can be any) and go another way: prices counted per (group, price) and stations per
(group, station), both combined before the shuffle, so such a group arrives as one row
per task and distinct value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricegrid.functions.keys import natural_key
from pricegrid.operators import scd2
from pricegrid.session import cut_lineage, dealt_to

PCTS = {"p10_price": 0.1, "median_price": 0.5, "p90_price": 0.9}
HOT_ROWS = 1 << 22  # of one group, collected in one task


def _at(prices: str, share: float) -> Column:
    """The percentile of a sorted array: between the two places around it."""
    place = (F.size(prices) - 1) * F.lit(share)
    low = F.floor(place).cast("int")
    next_one = F.get(prices, F.least(low + 1, F.size(prices) - 1))
    return F.when(place == low, F.get(prices, low)).otherwise((low + 1 - place) * F.get(prices, low) + (place - low) * next_one)


def _collected(rows: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    # Spark interpolates percentiles in DOUBLE; so does this
    tasks = dealt_to(rows.sparkSession, n)
    groups = ((rows.repartition(tasks, *keys) if tasks else rows.repartition(*keys)).groupBy(*keys)
              .agg(F.sort_array(F.collect_list(F.col("sale_price").cast("double"))).alias("_prices"),
                   F.count(F.lit(1)).alias("observations"), F.size(F.collect_set("reseller_cnpj")).cast("long").alias("stations"),
                   F.min("sale_price").alias("min_price"), F.max("sale_price").alias("max_price"),
                   F.sum("sale_price").alias("_sum")))
    return groups.select(*keys, "observations", "stations", *(_at("_prices", p).alias(n) for n, p in PCTS.items()),
                         "min_price", "max_price", "_sum")


def _counted(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same columns from counts per price and per station."""
    prices = rows.groupBy(*keys, "sale_price").agg(F.count(F.lit(1)).alias("_n"))
    stats = prices.groupBy(*keys).agg(
        F.sum("_n").alias("observations"), F.percentile(F.col("sale_price").cast("double"), list(PCTS.values()), F.col("_n")).alias("_p"),
        F.min("sale_price").alias("min_price"), F.max("sale_price").alias("max_price"),
        F.sum(F.col("sale_price") * F.col("_n")).alias("_sum"))
    stations = rows.select(*keys, "reseller_cnpj").distinct().groupBy(*keys).agg(F.count("reseller_cnpj").alias("stations"))
    return (stats.join(stations, list(keys))
            .select(*keys, "observations", "stations", *(F.col("_p")[i].alias(n) for i, n in enumerate(PCTS)),
                    "min_price", "max_price", F.col("_sum").cast("decimal(38,3)").alias("_sum")))


def _hot(fact: DataFrame, rows: DataFrame, keys: Sequence[str], limit: int) -> tuple[DataFrame | None, int]:
    """The groups of more than ``limit`` rows, None if there are none. No group has more
    rows than its week and product have in the fact. Also the rows of the fact."""
    week = F.date_trunc("week", "collection_date").cast("date").alias("week_start_date")
    counts = fact.groupBy(week, "product_key").agg(F.count(F.lit(1)).alias("_n"))
    n, most = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
    if most <= limit:
        return None, n
    large = counts.where(F.col("_n") > limit)
    found = (rows.join(large, ["week_start_date", "product_key"], "left_semi").groupBy(*keys)
             .agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).select(*keys))
    found = cut_lineage(found, "hot-groups")
    return (None if found.isEmpty() else found), n


def price_groups(fact: DataFrame, rows: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """Observations, stations, percentiles, extremes and average price of each group of
    ``rows`` (fact rows with ``keys``, week_start_date and product_key among them)."""
    rows = rows.select(*keys, "reseller_cnpj", "sale_price")
    hot, n = _hot(fact, rows, keys, HOT_ROWS if hot_rows is None else hot_rows)
    if hot is None:
        groups = _collected(rows, keys, n)
    else:
        groups = (_collected(rows.join(hot, list(keys), "left_anti"), keys, n)
                  .unionByName(_counted(rows.join(hot, list(keys), "left_semi"), keys)))
    # avg as sum/count in DOUBLE: exact decimal sum, one rounding
    average = F.col("_sum").cast("double") / F.col("observations")
    return groups.withColumn("avg_price", average).drop("_sum")


def enrich(fact: DataFrame, dim_station: DataFrame, dim_city: DataFrame,
           dim_date: DataFrame) -> DataFrame:
    """fact -> station version with its city (computed key) -> calendar.

    The city key is hashed and looked up once per station version, not per
    fact row; all join forms are AQE's choice by measured size.
    """
    s = dim_station.withColumn("city_key", natural_key("state", "city")).join(dim_city.select("city_key"), "city_key")
    f = scd2.join_versions(fact, s, ["city_key"])
    dt = dim_date.select("full_date", "survey_week_key", "week_start_date", "iso_year")
    return f.join(dt, f["collection_date"] == dt["full_date"])


def weekly_unmarked(fact: DataFrame, dim_station: DataFrame, dim_city: DataFrame,
                    dim_date: DataFrame) -> DataFrame:
    e = enrich(fact, dim_station, dim_city, dim_date)
    keys = ["survey_week_key", "week_start_date", "iso_year", "city_key", "product_key"]
    agg = price_groups(fact, e, keys)
    # month from the week start, not the date: a week crossing a month stays one row
    return agg.select(
        "survey_week_key", "week_start_date", "iso_year",
        F.date_trunc("month", F.col("week_start_date")).cast("date").alias("month_start_date"),
        *[c for c in agg.columns if c not in keys[:3]],
    )


def mark_edges(agg: DataFrame, week: str = "survey_week_key") -> DataFrame:
    """Flag the first and last week of the series; nothing is removed.
    min and max are scalar subqueries (merged into one by the optimizer)
    over ``agg``; pass a materialised aggregate so they do not re-run it."""
    lo = agg.agg(F.min(week)).scalar()
    hi = agg.agg(F.max(week)).scalar()
    return agg.withColumn("is_edge_week", F.col(week).isin(lo, hi))


def weekly(fact, dim_station, dim_city, dim_date, materialise: bool = True) -> DataFrame:
    """Rollup + edge flag. The unmarked aggregate (orders of magnitude smaller
    than the fact) is materialised first, so the edge bounds read it instead
    of re-running the fact joins inside the scalar subqueries."""
    agg = weekly_unmarked(fact, dim_station, dim_city, dim_date)
    return mark_edges(cut_lineage(agg) if materialise else agg)


def weekly_raw_keys(fact: DataFrame, dim_station: DataFrame) -> DataFrame:
    """Same statistics keyed by raw values: week by date_trunc, state, city."""
    e = scd2.join_versions(fact, dim_station, ["state", "city"]).withColumn(
        "week_start_date", F.date_trunc("week", F.col("collection_date")).cast("date"))
    keys = ["week_start_date", "state", "city", "product_key"]
    return price_groups(fact, e, keys)


def profile(weekly_df: DataFrame) -> DataFrame:
    return weekly_df.agg(
        F.count(F.lit(1)).alias("rollup_rows"),
        F.count_if(~F.col("is_edge_week")).alias("inner_rows"),
        F.count_if("is_edge_week").alias("edge_rows"),
        F.min("week_start_date").alias("first_week"),
        F.max("week_start_date").alias("last_week"),
        F.count_distinct("survey_week_key").alias("weeks"),
        F.count_distinct("city_key").alias("cities"),
        F.count_distinct("product_key").alias("products"),
    )


def reconcile(fact: DataFrame, weekly_df: DataFrame) -> DataFrame:
    """The rollup may neither lose nor invent observations."""
    f = fact.agg(F.count(F.lit(1)).alias("fact_rows"))
    return f.select("fact_rows",
                    weekly_df.agg(F.sum("observations")).scalar().alias("rollup_observations"))


def edge_coverage(weekly_df: DataFrame) -> DataFrame:
    """Observations of edge weeks as % of the median inner week."""
    per_week = weekly_df.groupBy("survey_week_key", "is_edge_week").agg(
        F.sum("observations").alias("obs"))
    inner_median = per_week.where(~F.col("is_edge_week")).agg(
        F.percentile("obs", 0.5)).scalar()
    return (per_week.groupBy("is_edge_week").agg(
        F.count(F.lit(1)).alias("weeks"), F.avg("obs").alias("_avg"))
        .select("is_edge_week", "weeks", F.round("_avg").alias("avg_observations"),
                F.round(F.try_divide(100 * F.col("_avg"), inner_median), 1)
                .alias("pct_of_inner_median"))
        .orderBy("is_edge_week"))
