"""Analyses on the weekly rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid import constants as K


def latest_inner_week(weekly: DataFrame):
    """Scalar subquery: the last week that is not an edge week."""
    return weekly.where(~F.col("is_edge_week")).agg(F.max("survey_week_key")).scalar()


def parity(weekly: DataFrame, dim_city: DataFrame, dim_product: DataFrame,
           numerator: str = K.PARITY_NUMERATOR, denominator: str = K.PARITY_DENOMINATOR,
           threshold: float = K.PARITY_THRESHOLD) -> DataFrame:
    """Median price of numerator / denominator product per city in the latest
    inner week, summarised by state: median ratio and share of cities under
    ``threshold``. City is in the grouping so products are paired in place."""
    w = weekly.where(~F.col("is_edge_week")
                     & (F.col("survey_week_key") == latest_inner_week(weekly)))
    j = (w.join(dim_city.select("city_key", "uf"), "city_key")
         .join(dim_product.select("product_key", "product_name"), "product_key"))
    pv = j.groupBy("uf", "city_key", "survey_week_key").agg(
        F.max(F.when(F.col("product_name") == numerator, F.col("median_price"))).alias("num"),
        F.max(F.when(F.col("product_name") == denominator, F.col("median_price"))).alias("den"))
    ratio = F.try_divide(F.col("num"), F.col("den"))
    ok = pv.where(F.col("num").isNotNull() & F.col("den").isNotNull() & (F.col("den") > 0))
    return (ok.groupBy("uf").agg(
        F.count(F.lit(1)).alias("cities"),
        F.round(100 * F.percentile(ratio, 0.5), 1).alias("median_ratio_pct"),
        F.round(100 * F.avg(F.when(ratio < threshold, 1).otherwise(0)), 1)
        .alias("pct_cities_below"))
        .orderBy(F.desc("pct_cities_below"), "uf"))
