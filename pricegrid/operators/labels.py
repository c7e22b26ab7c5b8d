"""Label aliasing: validated alias map, brand dimension, transitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricegrid import constants as K
from pricegrid.functions.keys import natural_key
from pricegrid.operators import checks


def check_chain(aliases: DataFrame) -> DataFrame:
    """Aliases whose target is itself an alias (order-dependent result)."""
    a, b = aliases.alias("a"), aliases.alias("b")
    return (a.join(b, F.col("a.canonical_brand") == F.col("b.source_brand"))
            .select("a.source_brand", "a.canonical_brand"))


def check_targets(aliases: DataFrame, clean: DataFrame, col: str = "brand") -> DataFrame:
    """Aliases whose canonical label never occurs in the data (a typo)."""
    seen = clean.select(F.col(col).alias("canonical_brand")).distinct()
    return (aliases.select("source_brand", "canonical_brand").distinct()
            .join(seen, "canonical_brand", "left_anti")
            .select("source_brand", "canonical_brand"))


def validate(aliases: DataFrame, clean: DataFrame, col: str = "brand") -> DataFrame:
    """Raise on a chained alias or a missing target; return the map."""
    checks.require_empty(check_chain(aliases), "chained alias in map")
    checks.require_empty(check_targets(aliases, clean, col), "canonical label absent from data")
    return aliases


def brand_dim(clean: DataFrame, aliases: DataFrame, unbranded: str = K.UNBRANDED,
              col: str = "brand", key: str = "reseller_cnpj") -> DataFrame:
    a = aliases.select(F.col("source_brand").alias("_src"), F.col("canonical_brand").alias("_c"))
    j = clean.join(a, clean[col] == a["_src"], "left")
    g = (j.groupBy(F.coalesce("_c", col).alias("brand_name"))
         .agg(F.count_distinct(key).alias("stations")))
    return g.select(natural_key("brand_name").alias("brand_key"), "brand_name",
                    (F.col("brand_name") == F.lit(unbranded)).alias("is_unbranded"), "stations")


def top(brand: DataFrame, k: int = 15) -> DataFrame:
    """Top-k labels by stations (the limit is the feature); ties by name."""
    return (brand.select("brand_name", "stations", "is_unbranded")
            .orderBy(F.desc("stations"), "brand_name").limit(k))


def transitions(obs: DataFrame, key: str = "reseller_cnpj", date: str = "collection_date",
                col: str = "brand") -> DataFrame:
    """Raw label changes per (from, to): events, distinct dates, stations.

    A station's label on a date is its smallest raw label that day (one row
    per station-date, built by an aggregate); the window then runs per station
    over at most one row per date.
    """
    day = obs.groupBy(key, date).agg(F.min(col).alias("_l"))
    w = Window.partitionBy(key).orderBy(date)
    ch = (day.withColumn("_prev", F.lag("_l").over(w))
          .where(F.col("_prev").isNotNull() & ~F.col("_l").eqNullSafe(F.col("_prev"))))
    return (ch.groupBy(F.col("_prev").alias("from_label"), F.col("_l").alias("to_label"))
            .agg(F.count(F.lit(1)).alias("events"),
                 F.count_distinct(date).alias("dates"),
                 F.count_distinct(key).alias("stations")))
